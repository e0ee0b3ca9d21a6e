"""Calendar means, completeness, scores, pages, user metrics, value contracts and kept partial sums."""

import datetime as dt
import math
import shutil
import statistics

import pytest
from pyspark.sql import functions as F

from epiledger.functions.expressions import metric_expression, with_metric
from epiledger.operators import contracts, estimates, pages, partials, scores, series, summaries

DAY = dt.date(2021, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


# --- calendar ----------------------------------------------------------------


def test_calendar_mean_shortens_over_gaps(spark):
    rows = [("a", day(0), 1.0), ("a", day(6), 3.0), ("a", day(7), 5.0), ("a", day(30), 7.0), ("a", None, 9.0), ("b", day(1), None)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    found = {(r.k, r.date): r.v_mean_7d for r in series.calendar_means(df, ["v"], ["k"]).collect()}
    assert found == {("a", day(0)): 1.0, ("a", day(6)): 2.0, ("a", day(7)): 4.0, ("a", day(30)): 7.0, ("a", None): 9.0, ("b", day(1)): None}
    zeros = {(r.k, r.date): r.v_mean_7d for r in series.calendar_means(df, ["v"], ["k"], absent_as_zero=True, digits=3).collect()}
    assert zeros["a", day(7)] == 1.143 and zeros["b", day(1)] == 0.0


def test_daily_summary_by_calendar(spark):
    frame = spark.createDataFrame([(day(0), 10.0), (day(1), 20.0), (day(20), 60.0)], "date date, new_confirmed double")
    for calendar, expected in ((False, [10.0, 15.0, 30.0]), (True, [10.0, 15.0, 60.0])):
        found = summaries.daily_summary(frame, calendar).collect()
        assert [r.rolling_avg_confirmed_7d for r in found] == expected


def test_completeness_counts_days_in_gaps(spark):
    rows = [("a", dt.date(2021, 1, 30), 1.0), ("a", dt.date(2021, 1, 30), None), ("a", dt.date(2021, 4, 2), None), ("b", day(0), None), (None, day(0), 1.0), ("c", None, 1.0)]
    df = spark.createDataFrame(rows, "location_key string, date date, v double")
    found = {(r.location_key, r.month): tuple(r)[2:] for r in series.completeness(df, ["v"]).collect()}
    assert found == {
        ("a", dt.date(2021, 1, 1)): (2, 1, 50.0, 1),
        ("a", dt.date(2021, 2, 1)): (28, 0, 0.0, 0),
        ("a", dt.date(2021, 3, 1)): (31, 0, 0.0, 0),
        ("a", dt.date(2021, 4, 1)): (2, 1, 50.0, 0),
        ("b", day(0)): (1, 1, 100.0, 0),
    }
    assert series.completeness(df.limit(0)).count() == 0


# --- scores ------------------------------------------------------------------

SCORED = [("a", 1.0), ("a", 2.0), ("a", 6.0), ("a", None), ("b", 4.0), ("b", 4.0), ("c", 5.0), (None, 1.0), (None, 3.0), ("d", None)]


def plain_score(group, value):
    values = [v for g, v in SCORED if g == group and v is not None]
    if value is None:
        return None
    spread = statistics.pstdev(values)
    return (value - statistics.fmean(values)) / spread if spread else 0.0


def test_zscores_of_constant_null_and_single_groups(spark):
    df = spark.createDataFrame(SCORED, "g string, v double")
    for r in scores.zscores(df, ["v"], ["g"]).collect():
        expected = plain_score(r.g, r.v)
        assert r.v_zscore == expected if expected is None else math.isclose(r.v_zscore, expected, abs_tol=1e-12)
    assert scores.zscores(df, ["v"], ["g"]).count() == len(SCORED)
    assert scores.zscores(df.limit(0), ["v"], ["g"]).count() == 0


def test_moments_merge_to_those_of_the_whole(spark):
    rows = [("g", 1e9 + k % 7, k % 5) for k in range(200)] + [("g", None, 9), ("h", None, 1)]
    df = spark.createDataFrame(rows, "g string, v double, part int")
    whole = {r.g: r.v for r in scores.moments(df, ["v"], ["g"]).collect()}
    merged = {r.g: r.v for r in scores.merge_moments(scores.moments(df, ["v"], ["g", "part"]), ["v"], ["g"]).collect()}
    assert merged["h"].n == 0 and merged["g"].n == whole["g"].n == 200
    assert math.isclose(merged["g"].mean, whole["g"].mean) and math.isclose(merged["g"].m2, whole["g"].m2, rel_tol=1e-6)  # a mean of 1e9 has 1e-7 of room


# --- pages -------------------------------------------------------------------


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pages_tile_the_table(spark, descending, size):
    rows = [(f"k{n % 9}" if n % 11 else None, float(n % 4) if n % 5 else None) for n in range(60)] + [("k1", 1.0)] * 3
    df = spark.createDataFrame(rows, "key string, value double").repartition(6)
    table = pages.paged(df, "value", ["key"], descending)
    sign = -1 if descending else 1
    order = lambda r: (r.value is None, sign * (r.value or 0), r.key is None, r.key or "")
    whole = sorted(table.collect(), key=lambda r: r.row)
    assert [r.row for r in whole] == list(range(63)) and [order(r) for r in whole] == sorted(map(order, whole))
    assert sorted((r.key or "", r.value or -1) for r in whole) == sorted((k or "", v or -1) for k, v in rows)
    seen, last = [], None
    for number in range(3 if size == 1 else 63 // size + 1):
        found = pages.page_after(table, "value", ["key"], size, last, descending).collect()
        assert found == pages.page(table, number, size).collect()
        if not found:
            break
        seen += found
        last = (found[-1].value, found[-1].key, found[-1].row)
    assert seen == whole[: len(seen)] and len(seen) == (3 if size == 1 else 63)


def test_seek_past_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None), ("b", None), (None, None)], "key string, value double")
    table = pages.paged(df, "value", ["key"])
    assert [r.key for r in pages.page_after(table, "value", ["key"], 5, (None, "a", 0)).collect()] == ["b", None]
    assert pages.page_after(table, "value", ["key"], 5, (None, None, 2)).count() == 0
    none = pages.paged(df.limit(0), "value", ["key"])
    assert pages.page_after(none, "value", ["key"], 5).count() == 0 and pages.page(none, 0, 5).count() == 0


# --- user metrics ------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("a + b * 2", 8.0), ("(a + b) * 2", 10.0), ("-a / b", -2 / 3), ("a / (b - 3)", None), ("a / z", None),
        ("coalesce(z, a)", 2.0), ("abs(-3) - +1", 2.0), ("sqrt(-1)", None), ("ln(0)", None), ("least(a, b, z)", 2.0),
        ("greatest(a, b) / 4", 0.75), ("1e308", None), ("1e200 * 1e200", None), ("`a`", None), ("odd name", None), (" a ", 2.0),
    ],
)
def test_user_metric(spark, text, expected):
    df = spark.createDataFrame([(2, 3.0, None)], "a int, b double, z double")
    if text in ("1e308", "`a`", "odd name"):
        with pytest.raises(ValueError):
            with_metric(df, "m", text)
    else:
        found = with_metric(df, "m", text).first().m
        assert found == expected if expected is None else math.isclose(found, expected)


@pytest.mark.parametrize(
    "text",
    [
        "", "a +", "missing + 1", "__import__('os')", "a.b", "a[0]", "lambda: a", "a if b else 1", "a ** b", "a // b",
        "a > b", "'text'", "True", "f(a)", "abs(a, b)", "abs(x=a)", "least(a)", "[a]", "a; b", "1e999", "1j", "a\n+b)", "(" * 300,
        "a" * 1001, "-" * 900 + "a b", "exec(a)", "abs(*a)", "a and b", "not a", "~a",
    ],
)
def test_user_metric_rejects(text):
    with pytest.raises(ValueError):
        metric_expression(text, ["a", "b"])


# --- contracts ---------------------------------------------------------------


def test_contracts_count_and_show_rows(spark):
    rows = [("a", 1, "5"), ("a", 1, "x"), ("b", None, None), (None, 3, "7"), ("c", 12, "8")]
    df = spark.createDataFrame(rows, "k string, v int, t string")
    rules = [
        contracts.required("v"), contracts.between("v", 2, 10), contracts.castable("t", "int"),
        contracts.one_of("k", ["a", "b"]), contracts.shaped("k", "^[ab]"), contracts.at_most("v", "v"),
    ]
    found = {r.rule: tuple(r)[1:] for r in contracts.check_values(df, rules, ["k", "v"]).collect()}
    assert found == {
        "v is there": (5, 1, "b|null", "b|null"),
        "v between 2 and 10": (5, 3, "a|1", "c|12"),
        "t reads as int": (5, 1, "a|1", "a|1"),
        "k is listed": (5, 1, "c|12", "c|12"),
        "k has the shape ^[ab]": (5, 1, "c|12", "c|12"),
        "v at most v": (5, 0, None, None),
        "keys are unique": (5, 1, "a|1", "a|1"),
    }
    empty = contracts.check_values(df.limit(0), rules, ["k"]).collect()
    assert len(empty) == 7 and {tuple(r)[1:] for r in empty} == {(0, 0, None, None)}


# --- partial sums ------------------------------------------------------------


def test_new_chunks_do_not_read_old_ones(spark, tmp_path):
    ddl = "date date, location_key string, new_confirmed double, new_deceased double, new_recovered double"
    parts = [
        [(day(0), "IN", 5.0, 1.0, 0.0), (day(1), "US", -4.0, None, 1.0), (None, "IN", 9.0, 9.0, 9.0)],
        [(day(0), "BR", 7.0, 0.0, 0.0), (day(2), "IN", 1.0, 1.0, 1.0), (day(2), "IN_MH", 50.0, 5.0, 5.0)],
    ]
    folder = str(tmp_path / "sums")
    for k, rows in enumerate(parts):
        source = tmp_path / f"chunk{k}"
        spark.createDataFrame(rows, ddl).write.parquet(str(source))
        for _ in range(2):  # delivered twice, counted once
            partials.store_chunk(spark.read.parquet(str(source)), folder, f"c{k}")
        shutil.rmtree(source)
    whole = estimates.daily_estimates(spark.createDataFrame(sum(parts, []), ddl), None).collect()
    assert partials.merged_daily(spark, folder).collect() == whole
    with pytest.raises(ValueError):
        partials.store_chunk(spark.createDataFrame(parts[0], ddl), folder, "../c")


def test_hot_key_of_a_named_join_is_split(spark):
    """A third of the facts under one key: the final plan splits the join of names."""
    from epiledger.operators.lookups import with_country_name

    facts = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HH")).otherwise(F.concat(F.lit("K"), F.col("id").cast("string"))).alias("location_key"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    ).repartition(4)
    index = facts.select("location_key", F.upper("location_key").alias("country_name")).distinct()
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        named = with_country_name(facts, index)
        assert named.count() == 60_000
        named.write.format("noop").mode("overwrite").save()
        rows = named.where("country_name IS NULL").count()
        counted = named.groupBy("location_key").count()
        counted.collect()
        named.collect()
        plan = named._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows == 0 and "skew=true" in plan.split("== Initial Plan ==")[0]
