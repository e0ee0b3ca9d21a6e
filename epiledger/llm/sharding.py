"""Shards of near-equal size out of groups that stay together."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiledger.llm.common import block_of_rows, numbered
from epiledger.sources.shared import as_table


def longest_first(sizes: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Longest processing time: by falling size, each item to the least loaded shard.

    Equal sizes go by key, equal loads by shard number.
    """
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, key in sorted(sizes, key=lambda x: (-x[0], str(x[1]))):
        load, shard = loads[0]
        placed[key] = shard
        heapq.heapreplace(loads, (load + size, shard))
    return placed


def shard_by_size(
    docs: DataFrame,
    shards: int = 24,
    id_column: str = "doc_id",
    text_column: str = "text",
    fine: int = 1024,
) -> DataFrame:
    """One row per document with its shard and its place there.

    A document weighs the UTF-8 bytes of its text plus 8.  Documents of equal text form a
    group and share a shard.  Groups go to shards by :func:`longest_first`.  So that the heap
    stays of one size on any corpus, a group is scheduled alone if it has at least
    ``1 / (shards * fine)`` of all bytes, and smaller groups are scheduled in at most
    ``shards * fine`` bundles dealt by the hash of their text: ``2 * shards * fine`` items at
    most, two numbers each.  A bundle is as a rule a few thousandths of a shard.

    Null texts weigh 8, have checksum 0 and form a group apart from empty texts.  Repeated rows
    count each.  Null ids are kept.  Of an empty table the result is empty.  Other columns are
    not read.

    Columns: the id, ``size``, ``text_crc32``, ``shard``, ``slot``, ``group_key``.
    """
    spark = docs.sparkSession
    text, items = F.col(text_column), shards * fine
    rows = as_table(
        docs.select(
            F.col(id_column),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.md5(text), F.lit("null")).alias("group_key"),
            block_of_rows().alias("_block"),
        ),
        "sharding-rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    bundle = F.pmod(F.xxhash64("group_key"), F.lit(items)).cast("int")
    alone = F.col("bytes") * items >= total
    scheduled = (
        rows.groupBy("group_key")
        .agg(F.sum("size").alias("bytes"))
        .groupBy(
            F.when(alone, F.col("group_key")).alias("group_key"),
            F.when(~alone, bundle).alias("bundle"),
        )
        .agg(F.sum("bytes").alias("bytes"))
        .collect()
    )
    placed = longest_first([(r.bytes, (r.group_key, r.bundle)) for r in scheduled], shards)
    groups = [(key, shard) for (key, _), shard in placed.items() if key is not None]
    bundles = [(number, shard) for (key, number), shard in placed.items() if key is None]
    by_group = spark.createDataFrame(groups, "group_key string, _alone int")
    by_bundle = spark.createDataFrame(bundles, "_bundle int, _bundled int")
    # Both have at most shards * fine rows.
    assigned = (
        rows.withColumn("_bundle", bundle)
        .join(F.broadcast(by_group), "group_key", "left")
        .join(F.broadcast(by_bundle), "_bundle", "left")
        .withColumn("shard", F.coalesce("_alone", "_bundled"))
        .drop("_bundle", "_alone", "_bundled")
    )
    order = [F.col(id_column), F.col("text_crc32")]
    return numbered(assigned, ["shard"], order, "_block", "slot").drop("_block")
