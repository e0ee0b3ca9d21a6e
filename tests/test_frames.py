import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from epiledger.operators.frames import country_frame, facts_frame, regional_frame
from epiledger.operators.unclean import raw_days, raw_results

DAY, NEXT = dt.date(2021, 1, 1), dt.date(2021, 1, 2)


def test_country_frame(cases, index, vaccinations, hospitalizations):
    frame = rows(
        country_frame(cases, index, vaccinations, hospitalizations), "location_key", "date"
    )
    assert set(frame) == {
        ("IN", DAY), ("IN", NEXT), ("US", DAY), ("US", NEXT), ("BR", DAY), ("BR", None),
        ("ZZ", DAY),
    }
    assert frame["IN", DAY]["new_persons_vaccinated"] == 5000.0
    assert frame["US", DAY]["new_persons_vaccinated"] == 0.0
    assert frame["US", DAY]["new_hospitalized_patients"] == 0.0
    assert frame["ZZ", DAY]["country_name"] is None
    assert frame["US", DAY]["cumulative_recovered"] is None


def test_missing_sides_leave_their_columns_out(cases, index):
    frame = country_frame(cases, index)
    assert "new_persons_vaccinated" not in frame.columns
    assert "new_hospitalized_patients" not in frame.columns


def test_repeated_reports_never_multiply(cases, index, vaccinations):
    cases3 = cases.union(cases).union(cases)
    vaccinations3 = vaccinations.union(vaccinations).union(vaccinations)
    once = country_frame(cases, index, vaccinations)
    many = country_frame(cases3, index, vaccinations3)
    assert sorted(map(str, once.collect())) == sorted(map(str, many.collect()))


def test_regional_frame(cases, index, vaccinations):
    frame = rows(regional_frame(cases, index, vaccinations), "location_key")
    assert set(frame) == {"US_CA", "US_CA_06", "IN_MH", "QQ_X"}
    assert frame["US_CA"]["parent_country"] == "United States"
    assert frame["US_CA"]["new_vaccine_doses_administered"] == 60.0
    assert frame["QQ_X"]["parent_country"] is None
    assert frame["QQ_X"]["country_code"] == "QQ"


def test_facts_frame_holds_both_levels(cases, index, vaccinations, hospitalizations):
    facts = facts_frame(cases, index, vaccinations, hospitalizations)
    country = country_frame(cases, index, vaccinations, hospitalizations)
    regional = regional_frame(cases, index, vaccinations)
    for level, frame in (("country", country), ("regional", regional)):
        same = facts.filter(F.col("level") == level).select(*frame.columns)
        assert sorted(map(str, same.collect())) == sorted(map(str, frame.collect()))


def test_one_hot_location_and_date(spark, index):
    """A third of all rows share one key; the frame still has one row for it."""
    cases = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN DATE'2021-01-01' "
        "ELSE date_add(DATE'2021-01-01', cast(id % 700 AS int)) END AS date",
        "CASE WHEN id % 3 = 0 THEN 'US' WHEN id % 2 = 0 THEN 'IN' ELSE 'BR' END AS location_key",
        "cast(id AS double) AS new_confirmed", "0D AS new_deceased", "0D AS new_recovered",
        "cast(id AS double) AS cumulative_confirmed", "0D AS cumulative_deceased", "id",
    )
    frame = country_frame(cases, index, order_by=["id"])
    hot = frame.filter("location_key = 'US'").collect()
    assert len(hot) == 1 and hot[0].new_confirmed == 0.0


def test_frames_shuffle_on_date_and_location(cases, index, vaccinations, hospitalizations):
    frame = country_frame(cases, index, vaccinations, hospitalizations)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan


def test_raw_totals_equal_those_of_the_pairs(cases, index, vaccinations, hospitalizations):
    """Repeated rows on all three sides, against the paired rows themselves."""
    cases2 = cases.union(cases.filter("location_key = 'IN'"))
    vaccinations2 = vaccinations.union(vaccinations).union(vaccinations)
    hospitalizations2 = hospitalizations.union(hospitalizations)
    numbers = [c for c in cases.columns if c not in ("date", "location_key")]
    pairs = (
        cases2.filter("length(location_key) = 2")
        .filter("new_confirmed IS NOT NULL OR cumulative_confirmed IS NOT NULL")
        .withColumns({c: F.col(c).try_cast("double") for c in numbers})
        .join(vaccinations2, ["date", "location_key"], "left")
        .join(hospitalizations2, ["date", "location_key"], "left")
        .join(index.select("location_key", "country_name"), "location_key", "left")
        .filter("country_name IS NOT NULL")
    )
    expected = rows(
        pairs.groupBy("location_key").agg(
            F.sum("new_confirmed").alias("total_confirmed"),
            F.sum("new_deceased").alias("total_deceased"),
            F.sum(F.col("new_persons_vaccinated").cast("double")).alias("total_vaccinated"),
            F.max("cumulative_confirmed").alias("peak_cumulative"),
        ),
        "location_key",
    )
    results = raw_results(raw_days(cases2, index, vaccinations2, hospitalizations2))
    found = rows(results["country_summary"], "location_key")
    for key, totals in expected.items():
        assert {c: found[key][c] for c in totals} == totals
    admitted = rows(results["hospitalization_summary"], "location_key")
    positive = pairs.filter(F.col("new_hospitalized_patients").cast("double") > 0)
    for r in positive.groupBy("location_key").agg(
        F.sum(F.col("new_hospitalized_patients").cast("double")).alias("s"),
        F.round(F.avg(F.col("new_hospitalized_patients").cast("double")), 2).alias("a"),
    ).collect():
        assert admitted[r.location_key]["total_hospitalized"] == r.s
        assert admitted[r.location_key]["avg_daily_hospitalized"] == r.a
    assert set(admitted) == {"IN"}


def test_raw_rows_keep_negatives(cases, index):
    days = rows(raw_days(cases, index), "location_key", "date")
    assert days["BR", DAY]["confirmed"] == -50.0
