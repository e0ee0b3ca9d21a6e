"""Links of fingerprints: odd rows, values that many share, other distances, and what is shuffled."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from epiledger.llm import simhash
from epiledger.llm.simhash import near_links


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def frame(spark, prints):
    return spark.createDataFrame([(p,) for p in prints], "fingerprint long")


def linked(df, **how):
    return sorted((r.a, r.b) for r in near_links(df, **how).collect())


def brute(prints, distance=3):
    known = sorted({p for p in prints if p is not None})
    return sorted(
        (a, b) for a, b in itertools.combinations(known, 2) if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance
    )


def clusters(rng, most):
    """Fingerprints around a few bases; in half of them only the bits of one run and the signs differ."""
    found = []
    for base in rng.integers(0, 1 << 63, 12).tolist():
        for near in (range(64), [4, 5, 6, 7, 63]):
            for _ in range(8):
                flips = rng.choice(near, rng.integers(0, most + 2) % (len(near) + 1), replace=False).tolist()
                found.append(signed(base ^ sum(1 << f for f in flips)))
    return found


def test_balls_are_not_listed_value_by_value(spark, monkeypatch):
    """With 33 values for each of two segments, 66 rows a fingerprint looked up; now 18 at most."""
    prints, sent, dealt = spark.range(2000).select(F.xxhash64("id").alias("fingerprint")), [], simhash.dealt
    monkeypatch.setattr(simhash, "dealt", lambda rows: sent.append(rows.count()) or dealt(rows))
    near_links(prints)
    assert 0 < sum(sent) <= 18 * 2000


def test_rows_are_sorted_by_what_differs_most(spark):
    prints = spark.range(10).select(F.xxhash64("id").alias("fingerprint"))
    assert "SortMergeJoin [segment" in near_links(prints)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("distance", "segments"), [(0, 2), (1, 2), (3, 2), (3, 3), (3, 4), (5, 2)])
def test_no_pair_is_lost_whatever_the_segments(spark, distance, segments):
    prints = clusters(np.random.default_rng(distance * 10 + segments), distance)
    assert linked(frame(spark, prints), distance=distance, segments=segments) == brute(prints, distance)


def test_null_and_repeated_fingerprints(spark):
    prints = [0, 0, 1, -1, -2, None, None, 7, 7, signed(1 << 63), signed((1 << 63) + 14), -(1 << 62)]
    assert linked(frame(spark, prints)) == brute(prints)
    assert linked(frame(spark, [None])) == linked(frame(spark, [])) == []


def test_a_segment_value_that_most_share(spark):
    high = np.random.default_rng(3).integers(0, 1 << 31, 300).tolist()
    prints = [h << 32 | 0xABCD1235 for h in high] + [h << 32 | 0xABCD1235 ^ 1 << b for b, h in enumerate(high[:32])]
    assert linked(frame(spark, prints)) == brute(prints)


def test_a_single_segment_is_refused(spark):
    with pytest.raises(ValueError, match="segments"):
        near_links(frame(spark, [1]), segments=1)
