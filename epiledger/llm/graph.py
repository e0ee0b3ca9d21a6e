"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiledger.sources.shared import as_table


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``label``) for every node of the links (``a``, ``b``); label: least node reached.

    Alternates the large-star and small-star steps: each node's greater, then smaller
    neighbours are linked to its least neighbour, until the links are stars around the least
    nodes.  The rounds grow with the logarithm of the component size.  Minima are pre-aggregated and
    each round is a stored table, so neither a node with many links nor a lost executor
    matters.
    """
    pair = lambda u, v: F.struct(F.greatest(u, v).alias("high"), F.least(u, v).alias("low"))

    def large_star(stars: DataFrame) -> DataFrame:
        both = stars.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            stars.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))

    def small_star(stars: DataFrame) -> DataFrame:
        least = stars.groupBy("high").agg(F.min("low").alias("m"))
        own = least.select("high", F.col("m").alias("low"))
        moved = (
            stars.join(least, "high").where("low > m")
            .select(F.col("low").alias("high"), F.col("m").alias("low"))
        )
        return own.unionByName(moved)

    stars = as_table(
        links.where("a <> b").select(pair(F.col("a"), F.col("b")).alias("p")).select("p.*").distinct(),
        "star",
    )
    seen = None
    while True:
        stars = as_table(small_star(large_star(stars)).distinct(), "star")
        state = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            break
        seen = state
    centres = stars.select(F.col("low").alias("node")).distinct()
    return stars.select(F.col("high").alias("node"), F.col("low").alias("label")).unionByName(
        centres.select("node", F.col("node").alias("label"))
    )
