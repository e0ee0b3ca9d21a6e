"""Row counts per country key: the map, shuffle and reduce of a line-oriented job.

Both functions take batch and streaming frames alike; a stream runs them in
complete mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiledger.functions.keys import is_country


def count_keys(rows: DataFrame) -> DataFrame:
    """Rows per two-character key, the key trimmed."""
    return (
        rows.select(F.trim("location_key").alias("location_key"))
        .filter(is_country())
        .groupBy("location_key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def add_counts(pairs: DataFrame) -> DataFrame:
    """Sum of text ``key<TAB>count`` lines per key; lines without a whole count skipped."""
    line = F.trim("value")
    key = F.substring_index(line, "\t", 1)
    count = F.split_part(line, F.lit("\t"), F.lit(2)).try_cast("long")
    return (
        pairs.select(key.alias("location_key"), count.alias("rows"))
        .filter(F.col("rows").isNotNull())
        .groupBy("location_key")
        .agg(F.sum("rows").alias("rows"))
    )
