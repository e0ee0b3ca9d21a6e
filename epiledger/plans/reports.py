"""Complete runs: inputs to stored results."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiledger.functions.metrics import number
from epiledger.operators.estimates import run_all_estimates
from epiledger.operators.frames import country_frame, facts_frame, regional_frame
from epiledger.operators.summaries import run_all
from epiledger.operators.unclean import raw_days, raw_results
from epiledger.sources.readers import (
    read_csv,
    read_demographics,
    read_optional_csv,
    read_parquet,
)
from epiledger.sources.shared import as_table, scratch_tables
from epiledger.sources.sinks import write_all_documents, write_results


@dataclass(frozen=True)
class Inputs:
    cases: DataFrame
    index: DataFrame
    vaccinations: DataFrame | None = None
    hospitalizations: DataFrame | None = None
    demographics: DataFrame | None = None
    continents: DataFrame | None = None
    overrides: DataFrame | None = None
    world: DataFrame | None = None


def _numbers(df: DataFrame | None) -> DataFrame | None:
    """Numbers in every column that is not a name, a key or a date."""
    if df is None:
        return None
    text = {"location_key", "country_name", "latest_data_date"}
    return df.withColumns({c: number(c) for c in df.columns if c not in text})


def read_inputs(spark: SparkSession, base: str) -> Inputs:
    """The CSV files of a folder; all but the first two are optional."""
    return Inputs(
        cases=read_csv(spark, base, "epidemiology.csv"),
        index=read_csv(spark, base, "index.csv"),
        vaccinations=read_optional_csv(spark, base, "vaccinations.csv"),
        hospitalizations=read_optional_csv(spark, base, "hospitalizations.csv"),
        demographics=read_demographics(spark, base),
        continents=read_optional_csv(
            spark, base, "continents.csv", ["location_key", "continent"]
        ),
        overrides=_numbers(read_optional_csv(spark, base, "overrides.csv", ["location_key"])),
        world=_numbers(read_optional_csv(spark, base, "world.csv")),
    )


def clean_country_frame(spark: SparkSession, base: str) -> DataFrame:
    """Country rows from the CSV files, cached for the results that share them."""
    i = read_inputs(spark, base)
    frame = country_frame(i.cases, i.index, i.vaccinations, i.hospitalizations)
    return frame.persist(StorageLevel.MEMORY_AND_DISK)


def clean_regional_frame(spark: SparkSession, base: str) -> DataFrame:
    i = read_inputs(spark, base)
    return regional_frame(i.cases, i.index, i.vaccinations)


def clean_results(
    inputs: Inputs, order_by: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The seven results off one clean table.

    The inputs are read, cleaned and joined once for both levels and written to
    the shared folder by level; each result then scans the columns and the level
    it needs.
    """
    facts = as_table(
        facts_frame(
            inputs.cases,
            inputs.index,
            inputs.vaccinations,
            inputs.hospitalizations,
            order_by=order_by,
        ),
        "facts",
        partition_by="level",
    )
    country = facts.filter(F.col("level") == "country").drop("level")
    regional = facts.filter(F.col("level") == "regional").drop("level")
    return run_all(country, inputs.demographics, regional)


def results_of(
    inputs: Inputs, variant: str = "clean", order_by: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Results in one of three variants: ``clean``, ``raw`` or ``estimated``."""
    if variant == "clean":
        return clean_results(inputs, order_by)
    if variant == "raw":
        days = raw_days(
            inputs.cases, inputs.index, inputs.vaccinations, inputs.hospitalizations
        )
        return raw_results(as_table(days, "raw-days"))
    if variant == "estimated":
        return run_all_estimates(
            inputs.cases,
            inputs.index,
            inputs.vaccinations,
            inputs.hospitalizations,
            inputs.demographics,
            inputs.continents,
            inputs.overrides,
            inputs.world,
        )
    raise ValueError(f"unknown variant {variant!r}")


def run(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    documents_path: str | None = None,
    variant: str = "clean",
) -> dict[str, int]:
    """Read, compute, store; documents are read off the stored results.

    Returns the documents written per result, empty when none are asked for.
    """
    with scratch_tables(spark):
        results = results_of(read_inputs(spark, input_path), variant)
        write_results(results, output_path)
        if documents_path is None:
            return {}
        stored = {name: read_parquet(spark, output_path, name) for name in results}
        return write_all_documents(stored, documents_path)


def session(app_name: str, master: str | None = None) -> SparkSession:
    """The active session, or a new one; cluster settings come from spark-submit."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    return builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Compute and store all results.")
    parser.add_argument("--input-path", required=True, help="folder of the CSV files")
    parser.add_argument("--output-path", required=True, help="folder for Parquet results")
    parser.add_argument("--documents-path", help="folder for document collections")
    parser.add_argument("--variant", default="clean", choices=["clean", "raw", "estimated"])
    parser.add_argument("--master", help="Spark master, when not set by spark-submit")
    options = parser.parse_args(arguments)
    spark = session("epiledger", options.master)
    run(
        spark,
        options.input_path,
        options.output_path,
        options.documents_path,
        options.variant,
    )
