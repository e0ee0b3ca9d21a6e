import json
from pathlib import Path

import pytest
from conftest import rows

from epiledger.operators import quality
from epiledger.sources import readers, sinks
from epiledger.sources.shared import as_table, checkpointed, shared_folder


@pytest.fixture
def result(spark):
    return spark.createDataFrame(
        [("India", "IN", 5.0, None), ("United States", "US", 7.0, 1.0)],
        "country_name string, location_key string, total_hospitalized double, "
        "peak_hospitalized double",
    )


def documents(path):
    return [json.loads(s) for f in Path(path).glob("*.json") for s in f.read_text().splitlines()]


def test_documents_replace_the_old_ones(spark, result, tmp_path):
    base = str(tmp_path)
    assert sinks.write_documents(result, base, "hospitalization_summary") == 2
    assert sinks.write_documents(result.limit(1), base, "hospitalization_summary") == 1
    assert len(documents(tmp_path / "hospitalization_summary")) == 1


def test_empty_input_leaves_documents_alone(result, tmp_path):
    base = str(tmp_path)
    sinks.write_documents(result, base, "c")
    assert sinks.write_documents(result.filter("false"), base, "c") == 0
    assert len(documents(tmp_path / "c")) == 2


def test_documents_leave_nulls_out_and_are_stamped(result, tmp_path):
    sinks.write_documents(result, str(tmp_path), "c", loaded_at="2024-05-01T00:00:00Z")
    india = next(d for d in documents(tmp_path / "c") if d["location_key"] == "IN")
    assert "peak_hospitalized" not in india and india["_loaded_at"] == "2024-05-01T00:00:00Z"


def test_load_all_counts(result, tmp_path):
    assert sinks.write_all_documents({"a": result, "b": result.limit(0)}, str(tmp_path)) == {
        "a": 2, "b": 0,
    }


def test_result_falls_back(spark, result, tmp_path):
    docs, parquet = str(tmp_path / "docs"), str(tmp_path / "parquet")
    name = "hospitalization_summary"
    assert readers.read_result(spark, name, docs, parquet)[1] == "none"
    sinks.write_results({name: result}, parquet)
    assert readers.read_result(spark, name, docs, parquet)[1] == "parquet"
    (tmp_path / "docs" / name).mkdir(parents=True)
    (tmp_path / "docs" / name / "part.json").write_text("")
    assert readers.read_result(spark, name, docs, parquet)[1] == "parquet"
    sinks.write_documents(result, docs, name)
    df, label = readers.read_result(spark, name, docs, parquet)
    assert label == "documents" and "_loaded_at" not in df.columns and df.count() == 2


def test_compact_parquet_is_one_file_when_small(spark, result, tmp_path):
    assert sinks.write_compact(result.repartition(8), str(tmp_path / "c")) == 2
    assert len(list((tmp_path / "c").glob("*.parquet"))) == 1
    sinks.write_compact(spark.range(100), str(tmp_path / "d"), rows_per_file=30)
    assert len(list((tmp_path / "d").glob("*.parquet"))) == 4
    assert spark.read.parquet(str(tmp_path / "d")).count() == 100


def test_counts_are_tab_separated_and_sorted(spark, tmp_path):
    df = spark.createDataFrame([("US", 2), ("BR", 1)], "location_key string, rows long")
    sinks.write_counts(df, str(tmp_path / "c"))
    lines = [s for f in sorted((tmp_path / "c").glob("*.csv")) for s in f.read_text().splitlines()]
    assert lines == ["BR\t1", "US\t2"]


def test_optional_sources(spark, tmp_path):
    base = str(tmp_path)
    assert readers.read_demographics(spark, base) is None
    (tmp_path / "demographics.csv").write_text("location_key,people\nIN,5\n")
    assert readers.read_demographics(spark, base) is None
    (tmp_path / "demographics.csv").write_text("location_key,population\nIN,5\nIN_MH,2\n")
    assert [r.location_key for r in readers.read_demographics(spark, base).collect()] == ["IN"]
    assert readers.read_csv(spark, base, "demographics.csv").dtypes[1] == ("population", "string")
    assert readers.read_typed_csv(spark, base, "demographics.csv").dtypes[1] == ("population", "int")
    assert readers.preview(readers.read_csv(spark, base, "demographics.csv"), 1).count() == 1


def test_shared_tables(spark, result):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (named or spark.sparkContext.getCheckpointDir())
    assert as_table(result, "t", partition_by="location_key").count() == 2
    assert checkpointed(result).count() == 2


def test_quality_report(spark, result):
    repeated = result.union(result.filter("location_key = 'IN'"))
    report = rows(quality.quality_reports({"r": repeated, "e": result.filter("false")}), "result")
    assert report["r"] == {
        "result": "r", "rows": 3, "columns": 4, "missing_cells": 2,
        "missing_pct": 16.67, "duplicates": 1,
    }
    assert report["e"]["missing_pct"] == 100.0


def test_contract_gaps(spark, result):
    gaps = quality.contract_gaps({"hospitalization_summary": result, "other": result})
    assert gaps == {"hospitalization_summary": ["avg_daily_hospitalized", "hospitalization_days"]}


def test_documents_keep_columns_and_types_of_any_result(spark, tmp_path):
    df = spark.createDataFrame(
        [("US", None, 3), ("FR", 1.5, 4)], "location_key string, never double, peak_cumulative long"
    )
    sinks.write_documents(df, str(tmp_path), "country_summary")
    back = readers.read_documents(spark, str(tmp_path), "country_summary")
    assert back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
