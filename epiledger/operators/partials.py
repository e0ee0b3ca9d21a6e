"""Partial sums kept per chunk of the facts, merged without reading old chunks again."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiledger.operators.estimates import daily_series, daily_sums


def store_chunk(cases: DataFrame, folder: str, chunk: str) -> None:
    """Sums one chunk of case reports by day and keeps the sums under its name.

    A chunk stored again replaces its former sums, so a repeated delivery or a retried job does
    not count twice.
    """
    if not re.fullmatch(r"[\w.-]+", chunk):
        raise ValueError(f"a chunk's name has letters, digits, dots, dashes and underscores: {chunk!r}")
    daily_sums(cases).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/part-{chunk}")


def merged_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The sums of all stored chunks as those of the whole; reads the kept sums only."""
    parts = spark.read.parquet(f"{folder.rstrip('/')}/part-*")
    metrics = [c for c in parts.columns if c != "date"]
    return parts.groupBy("date").agg(*[F.sum(c).alias(c) for c in metrics])


def merged_daily(spark: SparkSession, folder: str, vaccinations: DataFrame | None = None) -> DataFrame:
    """The estimated world series off the stored chunks."""
    return daily_series(merged_sums(spark, folder), vaccinations)
