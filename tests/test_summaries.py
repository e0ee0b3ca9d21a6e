import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from epiledger.operators import estimates, summaries
from epiledger.operators.cleaning import clean
from epiledger.operators.frames import country_frame, regional_frame
from epiledger.schema import RESULT_DDL

DAY, NEXT = dt.date(2021, 1, 1), dt.date(2021, 1, 2)


@pytest.fixture
def frame(cases, index, vaccinations, hospitalizations):
    return country_frame(cases, index, vaccinations, hospitalizations)


def test_country_summary(frame, demographics):
    found = rows(summaries.country_summary(frame, demographics), "location_key")
    assert set(found) == {"IN", "US", "BR"}
    india = found["IN"]
    assert india["total_confirmed"] == 31000.0
    assert india["active_cases"] == 1016000.0 - 15210.0 - 913000.0
    assert india["case_fatality_rate"] == 1.3226
    assert india["population"] == 1_400_000
    assert india["cases_per_million"] == 22142.86
    assert india["total_vaccinated"] == 10500.0
    assert india["days_reported"] == 2
    assert found["US"]["population"] == 0
    assert found["US"]["cases_per_million"] is None
    assert found["BR"]["population"] is None
    assert found["BR"]["active_cases"] == 0.0


def test_country_summary_columns(frame):
    expected = [c.split()[0] for c in RESULT_DDL["country_summary"].split(", ")]
    assert summaries.country_summary(frame).columns == expected


def test_null_date_is_latest_only_when_alone(spark):
    df = spark.createDataFrame(
        [("A", "AA", None, 50.0), ("A", "AA", DAY, 10.0), ("B", "BB", None, 70.0)],
        "country_name string, location_key string, date date, cumulative_confirmed double",
    ).withColumn("cumulative_deceased", F.lit(0.0))
    found = rows(summaries.country_summary(df), "location_key")
    assert found["AA"]["active_cases"] == 10.0
    assert found["BB"]["active_cases"] == 70.0


def test_global_metrics_counts_unnamed_locations(frame):
    row = summaries.global_metrics(frame).first()
    assert row.countries_reporting == 4
    assert row.total_cases == 31000.0 + 510000.0 + 7.0 + 40.0
    assert row.latest_data_date == NEXT
    assert row.active_cases_worldwide == 87790.0 + 19906900.0 + 0.0 + 32.0


def test_daily_summary(frame):
    found = rows(summaries.daily_summary(frame), "date")
    assert found[NEXT]["global_new_confirmed"] == 276000.0
    assert found[NEXT]["cumulative_global_confirmed"] == 7.0 + 265040.0 + 276000.0
    assert found[NEXT]["rolling_avg_7d"] == round((7 + 265040 + 276000) / 3)
    assert found[None]["global_new_confirmed"] == 7.0


def test_hospitalization_needs_positive_rows(frame):
    found = rows(summaries.hospitalization_summary(frame), "location_key")
    assert set(found) == {"IN"}
    assert found["IN"]["avg_daily_hospitalized"] == 812.5


def test_vaccination_days_count_positive_days(frame):
    found = rows(summaries.vaccination_summary(frame), "location_key")
    assert found["IN"]["vaccination_days"] == 2
    assert found["US"]["vaccination_days"] == 1


@pytest.mark.parametrize("name", ["vaccination_summary", "hospitalization_summary"])
def test_absent_metric_gives_full_schema(cases, index, name):
    empty = getattr(summaries, name)(country_frame(cases, index))
    assert empty.count() == 0
    assert empty.columns == [c.split()[0] for c in RESULT_DDL[name].split(", ")]


def test_regional_summary(cases, index, vaccinations):
    found = rows(
        summaries.regional_summary(regional_frame(cases, index, vaccinations)), "location_key"
    )
    assert found["US_CA"]["region_name"] == "United States"
    assert found["US_CA"]["total_people_vaccinated"] == 50.0
    assert found["QQ_X"]["region_name"] == "QQ_X"


def test_run_all_without_regional(frame):
    assert "regional_summary" not in summaries.run_all(frame)


def test_results_without_recovered(spark):
    df = spark.createDataFrame(
        [("India", "IN", DAY, 5.0, 1.0, 9.0, 2.0)],
        "country_name string, location_key string, date date, new_confirmed double, "
        "new_deceased double, cumulative_confirmed double, cumulative_deceased double",
    )
    assert summaries.global_metrics(df).first().active_cases_worldwide == 7.0
    assert summaries.country_summary(df).first().total_recovered is None


def test_estimates(cases, index, vaccinations, demographics, spark):
    overrides = spark.createDataFrame(
        [("IN", "India", 1000.0, 10.0, None, 5e6)],
        "location_key string, country_name string, total_confirmed double, "
        "total_deceased double, total_recovered double, population double",
    )
    found = rows(
        estimates.country_estimates(
            cases, index, vaccinations, demographics, overrides=overrides
        ),
        "location_key",
    )
    assert found["IN"]["continent"] == "Asia"
    assert found["IN"]["active_cases"] == 50.0
    assert found["IN"]["cases_per_million"] == 200.0
    assert found["US"]["cases_per_million"] == 0.0
    assert found["BR"]["total_confirmed"] == 14.0
    assert found["BR"]["total_vaccinated"] == 0.0


def test_regional_estimates_take_level_one_only(cases, index):
    found = rows(estimates.regional_estimates(cases, index), "location_key")
    assert set(found) == {"US_CA", "IN_MH"}
    assert found["US_CA"]["region_name"] == "California"


reports = st.lists(
    st.tuples(
        st.dates(dt.date(2021, 1, 1), dt.date(2021, 1, 20)),
        st.sampled_from(["AA", "BB", "CC"]),
        st.one_of(st.none(), st.integers(-50, 1000)),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(reports)
def test_totals_agree_across_results(spark, data):
    df = spark.createDataFrame(
        [(d, k, k, None if n is None else float(n)) for d, k, n in data],
        "date date, location_key string, country_name string, new_confirmed double",
    ).withColumns({"cumulative_confirmed": F.lit(1.0), "cumulative_deceased": F.lit(0.0)})
    tidy = clean(df)
    assert tidy.filter("new_confirmed < 0").isEmpty()
    by_day = summaries.daily_summary(tidy)
    world = summaries.global_metrics(tidy).first().total_cases
    assert by_day.agg(F.sum("global_new_confirmed")).first()[0] == world
    assert by_day.agg(F.max("cumulative_global_confirmed")).first()[0] == world
    country = summaries.country_summary(tidy)
    assert country.agg(F.sum("total_confirmed")).first()[0] == world
