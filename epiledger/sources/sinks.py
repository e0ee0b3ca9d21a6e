"""Where results go."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from epiledger.sources.shared import as_table


def for_each_result(
    results: Mapping[str, DataFrame], action: Callable[[str, DataFrame], None], at_once: int = 4
) -> None:
    """Runs an action on every result, some side by side.

    Results are jobs that do not wait for each other: while one ends in a few tasks or is still being
    planned, another keeps the executors busy.  The first failure is raised once all have ended.
    """
    if not results:
        return
    session = next(iter(results.values())).sparkSession
    run = inheritable_thread_target(session)(lambda item: action(*item))
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        for done in [pool.submit(run, item) for item in results.items()]:
            done.result()


def write_results(results: Mapping[str, DataFrame], base: str) -> None:
    """Parquet, one directory per result, overwritten."""
    for_each_result(
        results, lambda name, df: df.write.mode("overwrite").parquet(f"{base.rstrip('/')}/{name}")
    )


def write_compact(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> int:
    """Parquet in few files: small partitions are merged, none holds over ``rows_per_file``.

    The limit decides the number of files only; all rows are written.  The result is computed
    once and counted on the way.
    """
    seen = Observation("compact")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance")
    writer = counted.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return seen.get["rows"]


def as_documents(df: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """Rows stamped with their load time in UTC."""
    stamp = loaded_at or dt.datetime.now(dt.UTC).replace(tzinfo=None).isoformat() + "Z"
    return df.withColumn("_loaded_at", F.lit(stamp))


def as_json(df: DataFrame) -> DataFrame:
    """One JSON object per row, null fields left out, dates in ISO form."""
    return df.select(F.to_json(F.struct("*")).alias("document"))


def write_documents(df: DataFrame, base: str, name: str, loaded_at: str | None = None) -> int:
    """Replace a document collection; returns the number written.

    An empty input leaves the old collection as it is and returns 0.  The input is
    computed once, into the shared folder; executors write their own rows.  The schema is stored
    beside the collection.
    """
    kept = as_table(as_documents(df, loaded_at), f"documents-{name}")
    rows = kept.count()
    if rows:
        path = f"{base.rstrip('/')}/{name}"
        schema = df.sparkSession.createDataFrame([(kept.schema.json(),)], "value string")
        schema.coalesce(1).write.mode("overwrite").text(f"{path}.schema")
        kept.write.mode("overwrite").json(path)
    return rows


def write_all_documents(results: Mapping[str, DataFrame], base: str) -> dict[str, int]:
    return {name: write_documents(df, base, name) for name, df in results.items()}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_counts(counts: DataFrame, path: str, key: str = "location_key") -> None:
    """Tab-separated key and count, sorted by key."""
    counts.orderBy(key).write.mode("overwrite").option("sep", "\t").csv(path)
