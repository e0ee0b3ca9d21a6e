import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from epiledger.operators import cleaning

DAY = dt.date(2021, 1, 1)


def test_malformed_numbers_turn_null_then_zero(cases):
    clean = rows(cleaning.clean(cases), "location_key", "date")
    assert clean["BR", DAY]["new_deceased"] == 0.0
    assert clean["BR", DAY]["new_confirmed"] == 0.0


def test_uncleaned_metric_keeps_its_text(cases):
    clean = rows(cleaning.clean(cases), "location_key", "date")
    assert clean["US", DAY]["cumulative_recovered"] is None


def test_missing_keys_are_dropped(cases):
    clean = cleaning.clean(cases)
    assert clean.filter(F.col("location_key").isNull()).count() == 0
    assert clean.filter((F.col("location_key") == "US") & F.col("date").isNull()).count() == 0


def test_unreadable_dates_collapse_to_one_row(cases):
    clean = cleaning.clean(cases)
    assert clean.filter(F.col("date").isNull()).count() == 1
    assert cleaning.clean(cases, drop_bad_dates=True).filter(F.col("date").isNull()).count() == 0


def test_negative_stays_null_when_null(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "new_confirmed double")
    assert [r[0] for r in cleaning.clip_metrics(df).collect()] == [0.0, None, 2.0]


def test_clean_twice_changes_nothing(cases):
    once = cleaning.clean(cases, drop_bad_dates=True)
    twice = cleaning.clean(once)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_dedupe_keeps_first_by_order_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", None, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", None, "w")],
        "k string, o int, v string",
    )
    kept = rows(cleaning.dedupe(df, ["k"], ["o"]), "k")
    assert kept["a"]["v"] == "z" and kept["b"]["v"] == "w"


def test_dedupe_without_order_is_repeatable(spark):
    data = [("a", i, f"v{i}") for i in range(50)]
    first = cleaning.dedupe(spark.createDataFrame(data, "k string, o int, v string"), ["k"])
    again = spark.createDataFrame(data[::-1], "k string, o int, v string").repartition(7)
    assert first.collect() == cleaning.dedupe(again, ["k"]).collect()


def test_dedupe_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = cleaning.dedupe(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_rows_prefers_dates_over_nulls(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", DAY, 2), ("b", None, 3)], "k string, date date, v int"
    )
    kept = rows(cleaning.latest_rows(df, ["k"]), "k")
    assert kept["a"]["v"] == 2 and kept["b"]["v"] == 3


def test_timestamps_become_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 1, 5),)], "date timestamp")
    assert cleaning.parse_date(df).first().date == DAY


def test_default_dedupe_does_not_depend_on_arrival(spark):
    rows = [("k", 5, None), ("k", None, 5), ("k", 7, 1), ("j", None, None), ("j", 1, None)]
    found = []
    for given in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame(given, "key string, a int, b int")
        found.append(sorted(map(tuple, cleaning.dedupe(df, ["key"]).collect())))
    assert found[0] == found[1] == found[2] == [("j", 1, None), ("k", 5, None)]
