import datetime as dt

import pandas as pd
import pytest
from conftest import rows

from epiledger.operators import series

DAY = dt.date(2021, 1, 1)


def make(spark, pairs):
    return spark.createDataFrame(pairs, "date date, global_new_confirmed double")


@pytest.mark.parametrize("frequency,rule", [("daily", "D"), ("weekly", "W-SUN"), ("monthly", "MS")])
def test_resample_equals_pandas(spark, frequency, rule):
    pairs = [
        (DAY, 5.0), (DAY, 2.0), (dt.date(2021, 1, 3), 1.0), (dt.date(2021, 1, 4), None),
        (dt.date(2021, 2, 14), 9.0), (dt.date(2021, 6, 30), 4.0),
    ]
    found = series.resample(make(spark, pairs), frequency).collect()
    frame = pd.DataFrame(pairs, columns=["date", "v"])
    frame["date"] = pd.to_datetime(frame["date"])
    expected = frame.set_index("date")["v"].resample(rule).sum(min_count=1)
    assert [(r[0], r[1]) for r in found] == [
        (d.date(), None if pd.isna(v) else v) for d, v in expected.items()
    ]


def test_resample_of_nothing_is_nothing(spark):
    assert series.resample(make(spark, []), "weekly").count() == 0
    with pytest.raises(ValueError):
        series.resample(make(spark, []), "hourly")


def test_running_totals_carry_over_gaps(spark):
    pairs = [(DAY, 5.0), (dt.date(2021, 1, 3), 2.0)]
    total = series.running_totals(series.resample(make(spark, pairs), "daily"))
    assert [r.cumulative_confirmed for r in total.collect()] == [5.0, 5.0, 7.0]


def test_period_sums_and_last_values(spark):
    df = spark.createDataFrame(
        [
            ("A", "AA", DAY, 1.0, 10.0, 1.0),
            ("A", "AA", dt.date(2021, 1, 5), 2.0, 5.0, 9.0),
            ("A", "AA", dt.date(2021, 1, 9), 4.0, 99.0, 1.0),
            ("B", "BB", DAY, None, None, None),
        ],
        "country_name string, location_key string, date date, new_confirmed double, "
        "cumulative_confirmed double, cumulative_deceased double",
    )
    population = spark.createDataFrame(
        [("AA", 2_000_000), ("BB", 0)], "location_key string, population long"
    )
    found = rows(series.period_summary(df, "2021-01-01", "2021-01-05", population), "location_key")
    assert found["AA"]["total_confirmed"] == 3.0
    assert found["AA"]["cumulative_confirmed"] == 5.0
    assert found["AA"]["active_cases"] == 0.0
    assert found["AA"]["cases_per_million"] == 1.5
    assert found["BB"]["total_confirmed"] == 0.0
    assert found["BB"]["cases_per_million"] is None


def test_selected_daily_keeps_null_days(spark):
    df = spark.createDataFrame(
        [("A", DAY, None), ("B", DAY, 7.0)],
        "country_name string, date date, new_confirmed double",
    )
    assert series.selected_daily(df, ["A"]).first().global_new_confirmed is None
    assert series.selected_daily(df, []).first().global_new_confirmed == 7.0


def test_month_pivot_fills_gaps(spark):
    df = spark.createDataFrame(
        [("A", DAY, 5.0), ("A", dt.date(2021, 3, 2), 1.0), ("B", DAY, 9.0), ("C", DAY, 1.0)],
        "country_name string, date date, new_confirmed double",
    )
    found = rows(series.month_pivot(df, "new_confirmed", 2), "country_name")
    assert found == {
        "A": {"country_name": "A", "2021-01-01": 5.0, "2021-03-01": 1.0},
        "B": {"country_name": "B", "2021-01-01": 9.0, "2021-03-01": 0.0},
    }


def test_peak_takes_first_date(spark):
    pairs = [(DAY, 1.0), (dt.date(2021, 1, 2), 8.0), (dt.date(2021, 1, 3), 8.0)]
    assert tuple(series.peak_period(make(spark, pairs)).first()) == (
        8.0, dt.date(2021, 1, 2), 3,
    )


def test_date_range_ends(spark):
    df = make(spark, [(DAY, 1.0), (dt.date(2021, 1, 2), 2.0)])
    assert series.between_dates(df, None, "2021-01-01").count() == 1
    assert series.between_dates(df, "2021-01-02", None).count() == 1
    assert series.between_dates(df, None, "2021-01-01", whole_last_day=False).count() == 1
