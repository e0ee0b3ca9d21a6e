"""Several results off one scan: how often a final plan reads its facts, and what it gives."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from epiledger.operators import explore, quality, summaries
from epiledger.operators.frames import country_frame
from verification.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["kpis", "kpis_from_countries", "enriched_country_metrics"])
def test_facts_are_read_once(spark, name):
    df = QUERIES[name](spark, SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("FileScan" in line and "/orders.parquet" in line for line in plan.splitlines()) == 1


def test_key_figures_equal_those_of_results(spark, cases, index):
    frame = country_frame(cases, index)
    results = summaries.global_metrics(frame), summaries.country_summary(frame), summaries.daily_summary(frame)
    for by_world, world in ((True, results[0]), (False, None)):
        for defaults in (None, {"active_cases": 22.0, "total_people_vaccinated": 7.0, "countries_regions": 9}):
            stacked = explore.kpis(world, *results[1:], defaults)
            found = explore.key_figures(frame, by_world, defaults)
            assert found.first().asDict() == stacked.first().asDict()
    none = frame.limit(0)
    empty = explore.kpis(summaries.global_metrics(none), summaries.country_summary(none), summaries.daily_summary(none))
    assert explore.key_figures(none).first().asDict() == empty.first().asDict()


def test_quality_counts_repeated_rows_in_full(spark):
    df = spark.createDataFrame(
        [(1, None), (1, None), (None, "1"), (2, "a"), (2, "a"), (2, "a"), (None, None)], "a long, b string"
    )
    rows = {r.result: r for r in quality.quality_reports({"x": df, "y": df.distinct(), "z": df.limit(0)}).collect()}
    assert [(rows[k].rows, rows[k].missing_cells, rows[k].duplicates) for k in "xyz"] == [(7, 5, 3), (4, 4, 0), (0, 0, 0)]
    assert (rows["x"].missing_pct, rows["z"].missing_pct) == (35.71, 100.0)


def test_each_result_is_computed_once(spark):
    """A result without repeated rows is not read again."""
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(50).mapInArrow(noted, "id long").withColumn("b", F.lit(1))
    assert quality.quality_reports({"x": df}).first().duplicates == 0
    assert seen.value == 50
