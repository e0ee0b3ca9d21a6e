"""Prefix trie against plain Python, with nulls, ties, long conversations and repeated rows."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from epiledger.llm.prefix_trie import conversation_trie

DDL = "conv_id long, turn long, role string, text string, key string, block long"


def plain(rows):
    """Nodes by their sequence of turns, as the contract words them."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(set)
    ends = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c / 5) * 5
        path = tuple(own.get(c - base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    found = set()
    for path, inside in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        joined = ",".join(map(str, sorted(ends.get(path, []))))
        found.add((
            min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside),
            sum(len(p) == len(path) + 1 for p in below), len(leaves), saved, hashlib.sha256(joined.encode()).hexdigest(),
        ))
    return found


def trie(spark, rows, block_bits=16):
    c = F.col("conv_id")
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)
    found = conversation_trie(df, c - c % 5, F.crc32(c.cast("string")) % 9, 8, block_bits).collect()
    assert len(set(found)) == len(found)
    return {tuple(r) for r in found}


def rows_of():
    rows = []
    for c in range(-6, 40):
        for t in range((c * 7) % 11):
            rows.append((c, t, "user" if t % 2 else "assistant", f"turn é {t % 3} of {c % 4}"))
    rows += [(100 + 5 * k, t, "user", f"same {t}") for k in range(7) for t in range(10)]  # whole copies
    rows += [(200, None, None, None), (200, None, "user", None), (200, 1, "user", "tie"), (200, 1, "assistant", "tie")]
    rows += [(205, 0, "user", "again")] * 9  # repeated rows
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    rows += [(301, t, "user", f"short {t}") for t in range(2)]  # no base: nothing may be left
    rows += [(400, t, "user", f"long {t}") for t in range(300)]
    rows += [(401, t, "user", f"long {t}") for t in range(299)] + [(402, t, "user", f"long {t}") for t in range(300)]
    return rows + [(500, 0, "user", "x" * 500_000)]


@pytest.mark.parametrize("block_bits", [16, 3])
def test_equals_plain_python(spark, block_bits):
    rows = rows_of()
    assert trie(spark, rows, block_bits) == plain(rows)


def test_small_tables(spark):
    assert trie(spark, []) == set()
    assert trie(spark, [(None, 1, "user", "x")]) == set()
    one = [(7, None, None, None)]
    assert trie(spark, one) == plain(one)
    turnless = [(3, 0, "user", "a")]
    assert trie(spark, turnless) == plain(turnless)


def test_prefixes_of_others_are_no_leaves(spark):
    rows = [(c, t, "user", f"{t}") for c, n in ((0, 12), (5, 9), (10, 12), (15, 10)) for t in range(n)]
    found = trie(spark, rows)
    assert found == plain(rows)
    assert next(r for r in found if r[1] == 0)[5] == 1
