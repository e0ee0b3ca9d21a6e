"""Scans of facts, dimensions and results."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiledger.functions.keys import is_country
from epiledger.schema import RESULT_DDL


def read_csv(
    spark: SparkSession, base: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """A CSV file with a header, every field text; ``columns`` narrows the parse."""
    df = spark.read.option("header", True).csv(f"{base.rstrip('/')}/{name}")
    return df.select(*columns) if columns else df


def read_typed_csv(
    spark: SparkSession, base: str, name: str, ddl: str | None = None
) -> DataFrame:
    """A CSV file with types from ``ddl``, or inferred by an extra pass without it."""
    reader = spark.read.option("header", True)
    reader = reader.schema(ddl) if ddl else reader.option("inferSchema", True)
    return reader.csv(f"{base.rstrip('/')}/{name}")


def is_missing(error: AnalysisException) -> bool:
    """Whether the path is not there; any other failure is one."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_optional_csv(
    spark: SparkSession, base: str, name: str, required: Sequence[str] = ()
) -> DataFrame | None:
    """The file, or None where it is missing or lacks a required column."""
    try:
        df = read_csv(spark, base, name)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None
    return df if all(c in df.columns for c in required) else None


def read_demographics(spark: SparkSession, base: str) -> DataFrame | None:
    df = read_optional_csv(spark, base, "demographics.csv", ["location_key", "population"])
    return None if df is None else df.filter(is_country()).select("location_key", "population")


def preview(df: DataFrame, rows: int = 500) -> DataFrame:
    """The first rows of a source, for looking at it."""
    return df.limit(rows)


def read_parquet(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}")


def read_documents(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A document collection without its bookkeeping fields.

    The schema stored beside it gives back every column with its type; a collection that
    came without one is inferred.
    """
    path = f"{base.rstrip('/')}/{name}"
    reader = spark.read
    try:
        stored = spark.read.text(f"{path}.schema").first()
        reader = reader.schema(T.StructType.fromJson(json.loads(stored[0])))
    except AnalysisException as error:
        if not is_missing(error):
            raise
    return reader.json(path).drop("_id", "_loaded_at")


def read_result(
    spark: SparkSession, name: str, documents: str | None = None, parquet: str | None = None
) -> tuple[DataFrame, str]:
    """A result and where it came from: documents, else Parquet, else an empty frame."""
    for base, read, label in (
        (documents, read_documents, "documents"),
        (parquet, read_parquet, "parquet"),
    ):
        if base is None:
            continue
        try:
            df = read(spark, base, name)
        except AnalysisException as error:
            if not is_missing(error):
                raise
            continue
        if label == "parquet" or not df.isEmpty():
            return df, label
    return spark.createDataFrame([], RESULT_DDL.get(name, "location_key string")), "none"


def read_key_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed second field of a CSV file, rows without one left out."""
    df = spark.read.option("header", True).csv(path)
    return df.select(F.trim(F.col(df.columns[1])).alias("location_key")).filter(
        F.col("location_key").isNotNull()
    )
