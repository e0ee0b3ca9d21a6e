"""Exact quantiles that never hold a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epiledger.sources.shared import as_table


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: str | None = None
) -> DataFrame:
    """Linearly interpolated quantiles, one array column ``quantiles`` per group.

    Spark's ``percentile`` keeps every distinct value of a group in one buffer.
    Here equal values are counted map-side, so a value holding most rows is one
    row; the counts are range-partitioned by group and value, as evenly as distinct
    values allow and into as many parts as the session shuffles into; and a rank is the
    running count inside a part plus the totals of the group's parts before.  Counts and parts
    are stored: the source is read once, and parts stay what they are when an
    executor is lost.

    Nulls do not count; a group without values has null quantiles.
    """
    group = ["_group"] if by else []
    rows = df.select(
        *([F.struct(by).alias("_group")] if by else []), F.col(value).alias("_value")
    )
    counts = as_table(
        rows.groupBy(*group, "_value").agg(F.count("_value").alias("_n")), "value-counts"
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = as_table(
        counts.repartitionByRange(parts, *group, "_value").withColumn(
            "_block", F.spark_partition_id()
        ),
        "value-ranges",
    )
    ordered_blocks = Window.partitionBy(*group).orderBy("_block")
    before = ordered_blocks.rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy(*group, "_block")
        .agg(F.sum("_n").alias("_rows"))
        .select(
            *group,
            "_block",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_rows").over(Window.partitionBy(*group)).alias("_total"),
        )
    )
    within = Window.partitionBy(*group, "_block").orderBy("_value")
    ranked = placed.join(blocks, [*group, "_block"]).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(within)
    )

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - 1)

    def value_at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank, F.col("_value")))

    ends = []
    for i, p in enumerate(probabilities):
        ends.append(value_at(F.floor(position(p))).alias(f"_low{i}"))
        ends.append(value_at(F.ceil(position(p))).alias(f"_high{i}"))
    picked = ranked.groupBy(*group).agg(F.max("_total").alias("_total"), *ends)

    def interpolated(i: int, p: float) -> Column:
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        return low + (high - low) * (position(p) - F.floor(position(p)))

    quantiles = F.array(*[interpolated(i, p) for i, p in enumerate(probabilities)])
    columns = [quantiles.alias("quantiles")]
    if by:
        columns.insert(0, F.col("_group")[by].alias(by))
    return picked.select(*columns)
