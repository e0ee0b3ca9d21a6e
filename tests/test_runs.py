"""Whole runs from CSV files, and the line-count job on batches and streams."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from epiledger.plans import reports, views
from epiledger.sources.readers import read_key_lines
from epiledger.streaming.key_counts import add_counts, count_keys


@pytest.fixture
def folder(tmp_path, cases, index, vaccinations, hospitalizations, demographics):
    base = tmp_path / "in"
    for name, df in {
        "epidemiology": cases, "index": index, "vaccinations": vaccinations,
        "hospitalizations": hospitalizations, "demographics": demographics,
    }.items():
        df.write.option("header", True).csv(f"{base}/{name}.csv")
    return str(base)


def test_clean_run(spark, folder, tmp_path):
    out, docs = str(tmp_path / "out"), str(tmp_path / "docs")
    written = reports.run(spark, folder, out, docs)
    assert written == {
        "global_metrics": 1, "country_summary": 3, "daily_summary": 3,
        "country_daily_summary": 6, "vaccination_summary": 3,
        "hospitalization_summary": 1, "regional_summary": 4,
    }
    country = rows(spark.read.parquet(f"{out}/country_summary"), "location_key")
    assert country["IN"]["cases_per_million"] == 22142.86


@pytest.mark.parametrize("variant,results", [("raw", 4), ("estimated", 5)])
def test_other_variants(spark, folder, tmp_path, variant, results):
    written = reports.run(spark, folder, str(tmp_path / "out"), str(tmp_path / "docs"), variant)
    assert len(written) == results and all(written.values())


def test_run_with_cases_only(spark, folder, tmp_path):
    base = tmp_path / "bare"
    for name in ("epidemiology", "index"):
        spark.read.option("header", True).csv(f"{folder}/{name}.csv").write.option(
            "header", True
        ).csv(f"{base}/{name}.csv")
    reports.run(spark, str(base), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/vaccination_summary")).count() == 0
    country = spark.read.parquet(str(tmp_path / "out/country_summary"))
    assert country.filter("population IS NOT NULL").isEmpty()


def test_frames_from_files(spark, folder):
    frame = reports.clean_country_frame(spark, folder)
    assert frame.is_cached and frame.count() == 7
    frame.unpersist()
    assert reports.clean_regional_frame(spark, folder).count() == 4


def test_unknown_variant(spark, folder):
    with pytest.raises(ValueError):
        reports.results_of(reports.read_inputs(spark, folder), "other")


def test_key_counts(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("date,location_key,n\n2021-01-01, US ,1\n2021-01-01,US,1\nshort\n2021,US_CA,1\n2021,IN,\n")
    counts = rows(count_keys(read_key_lines(spark, str(path))), "location_key")
    assert {k: v["rows"] for k, v in counts.items()} == {"US": 2, "IN": 1}


def test_add_counts_skips_broken_lines(spark):
    lines = spark.createDataFrame([("US\t2",), ("US\tx",), ("US",), ("",), (" IN\t3 ",), ("US\t5",)], "value string")
    counts = rows(add_counts(lines), "location_key")
    assert {k: v["rows"] for k, v in counts.items()} == {"US": 7, "IN": 3}


def test_key_counts_of_a_stream(spark, tmp_path):
    source = tmp_path / "stream"
    source.mkdir()
    (source / "a.csv").write_text("date,location_key\n2021-01-01,US\n2021-01-02,IN\n")
    (source / "b.csv").write_text("date,location_key\n2021-01-01,US\n2021-01-02,US_CA\n")
    stream = (
        spark.readStream.option("header", True)
        .option("maxFilesPerTrigger", 1)
        .schema("date string, location_key string")
        .csv(str(source))
    )
    query = (
        count_keys(stream).writeStream.outputMode("complete").format("memory")
        .queryName("key_counts").option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    counts = rows(spark.table("key_counts"), "location_key")
    assert {k: v["rows"] for k, v in counts.items()} == {"US": 2, "IN": 1}


def test_views(spark, folder, tmp_path):
    results = reports.results_of(reports.read_inputs(spark, folder))
    daily = results["daily_summary"].filter(F.col("date").isNotNull())
    view = views.View("2021-01-01", "2021-01-02", ["India"], {"total_confirmed": 1})
    country = views.country_view(results["country_daily_summary"], view)
    assert [r.total_confirmed for r in country.collect()] == [31000.0]
    series = views.series_view(daily, results["country_daily_summary"], view)
    assert [r.global_new_confirmed for r in series.collect()] == [15000.0, 16000.0]
    world = views.series_view(daily, results["country_daily_summary"], views.View(frequency="monthly"))
    assert world.count() == 1
    found = views.explore(results["country_summary"], "INDIA", "total_confirmed", export_to=str(tmp_path / "e"))
    assert found.count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "e")).count() == 1


def test_estimated_run_with_absent_inputs_and_columns(spark, cases, index):
    from epiledger.operators.estimates import run_all_estimates, vaccination_totals

    results = run_all_estimates(cases, index, None, None, None)
    assert set(results) == {"country_summary", "daily_summary", "regional_summary"}
    country = {r.location_key: r for r in results["country_summary"].collect()}
    assert country["US"].population == 0.0 and country["US"].total_people_vaccinated == 0.0
    assert results["daily_summary"].count() > 0
    few = spark.createDataFrame([("2021-01-01", "IN")], "date string, location_key string")
    assert vaccination_totals(few, index).first().total_vaccinated == 0.0
