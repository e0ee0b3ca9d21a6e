"""Data quality of results, and the columns their readers rely on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiledger.schema import REQUIRED_COLUMNS
from epiledger.sources.shared import as_table


def _hashed(df: DataFrame) -> DataFrame:
    """The rows with two hashes that also tell where nulls are, and their missing cells."""
    nulls = [F.col(c).isNull() for c in df.columns]
    missing = reduce(lambda total, c: total + c.cast("long"), nulls, F.lit(0).cast("long"))
    return df.select(
        "*",
        F.xxhash64(*df.columns, *nulls).alias("_h1"),
        F.xxhash64(*nulls, *reversed(df.columns)).alias("_h2"),
        missing.alias("_missing"),
    )


def _repeated(df: DataFrame, again: DataFrame) -> int:
    """Rows that equal an earlier one, among the rows whose hashes occur again."""
    rows = _hashed(df).join(again, ["_h1", "_h2"], "left_semi").groupBy(*df.columns)
    return rows.agg(F.count(F.lit(1)).alias("_n")).agg(F.sum(F.col("_n") - 1)).first()[0] or 0


def quality_reports(results: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, missing cells, missing percent and repeated rows: one report row per result.

    All results go through one pass together: a row becomes its result's name, two hashes and a count,
    equal ones are added up map-side, and the table of counts is stored.  Only a result in which hashes
    occur more than once is read again, for those rows alone, which are then compared in full; give
    such results as stored tables.  An empty result is 100 % missing.
    """
    narrow = [
        _hashed(df).select(F.lit(name).alias("result"), "_h1", "_h2", "_missing") for name, df in results.items()
    ]
    counts = as_table(
        reduce(DataFrame.unionByName, narrow)
        .groupBy("result", "_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_missing").alias("_missing")),
        "row-hashes",
    )
    totals = {
        r.result: r
        for r in counts.groupBy("result")
        .agg(F.sum("_n").alias("rows"), F.sum("_missing").alias("missing"), F.max("_n").alias("most"))
        .collect()
    }  # one row per result
    reports = []
    for name, df in results.items():
        width, found = len(df.columns), totals.get(name)
        repeated = 0
        if found and found.most > 1:
            again = counts.where((F.col("result") == name) & (F.col("_n") > 1))
            repeated = _repeated(df, again.select("_h1", "_h2"))
        reports.append((name, found.rows if found else 0, width, found.missing if found else 0, repeated))
    share = F.round(F.lit(100.0) * F.col("missing_cells") / F.greatest(F.col("rows") * F.col("columns"), F.lit(1)), 2)
    return (
        counts.sparkSession.createDataFrame(
            reports, "result string, rows long, columns int, missing_cells long, duplicates long"
        )
        .withColumn("missing_pct", F.when(F.col("rows") == 0, F.lit(100.0)).otherwise(share))
        .select("result", "rows", "columns", "missing_cells", "missing_pct", "duplicates")
    )


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def contract_gaps(results: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Required columns absent from each result that has a contract."""
    return {
        name: missing_columns(df, REQUIRED_COLUMNS[name])
        for name, df in results.items()
        if name in REQUIRED_COLUMNS
    }


def row_counts(results: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per result."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("result"), "rows")
        for name, df in results.items()
    ]
    return reduce(DataFrame.unionByName, counts)
