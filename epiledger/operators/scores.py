"""Standard scores within groups, off moments that can be kept and merged."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, metrics: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per group: for each metric a struct of ``n``, ``mean`` and ``m2``.

    ``m2`` is the sum of squared distances from the mean.  Null values do not count.  One hash aggregation
    with map-side combine, so a group holding most rows sends one row a task.
    """
    return df.groupBy(*by).agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                (F.var_pop(c) * F.count(c)).alias("m2"),
            ).alias(c)
            for c in metrics
        ]
    )


def merge_moments(parts: DataFrame, metrics: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Moments of several pieces of the data as those of the whole.

    Two pieces merge by their counts and the distance of their means, so nothing cancels as in a
    sum of squares.  A group has one row a piece.
    """

    def pair(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        merged = F.struct(
            n.alias("n"),
            (a["mean"] + apart * (b["n"] / n)).alias("mean"),
            (a["m2"] + b["m2"] + apart * apart * (a["n"] * (b["n"] / n))).alias("m2"),
        )
        return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(merged)

    none = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("m2")
    )
    return parts.groupBy(*by).agg(*[F.aggregate(F.collect_list(c), none, pair).alias(c) for c in metrics])


def zscores(
    df: DataFrame,
    metrics: Sequence[str],
    by: Sequence[str],
    digits: int | None = None,
    known: DataFrame | None = None,
    suffix: str = "_zscore",
) -> DataFrame:
    """Each metric's distance from its group's mean, in the group's standard deviations (of the population).

    In a group without spread, or of one value, every score is 0; a null value has a null score.  Rows
    without a group are a group of their own.  ``known`` gives moments kept from before, such as merged
    ones; otherwise they are computed from the frame.  They are joined back once; Spark broadcasts them
    where they are small and else splits hot groups.
    """
    keys = [f"_group_{k}" for k in range(len(by))]
    source = moments(df, metrics, by) if known is None else known
    side = source.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], *[F.col(c).alias(f"_moments_{c}") for c in metrics]
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, keys, strict=True)])

    def score(c: str) -> Column:
        m = F.col(f"_moments_{c}")
        spread = F.sqrt(m["m2"] / F.when(m["n"] > 0, m["n"]))
        value = F.when(F.col(c).isNull(), None).when(spread > 0, (F.col(c) - m["mean"]) / spread).otherwise(F.lit(0.0))
        return (F.round(value, digits) if digits is not None else value).alias(f"{c}{suffix}")

    return df.join(side, same, "left").select(*df.columns, *[score(c) for c in metrics])
