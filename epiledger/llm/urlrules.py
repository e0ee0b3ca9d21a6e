"""Allow and block rules for urls as a sort-merge range join."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAMPLE = 20_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://`` up to ``/``, ``?``, ``#``; then up to ``?`` or ``#``."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def host_key(host: Column) -> Column:
    """Labels from the last to the first, a dot after each: a domain is a prefix of its hosts."""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


class _Level:
    """An active rule host: its rules by path, and the lengths that occur."""

    def __init__(self, key: str):
        self.key, self.rules, self.lengths = key, {}, []

    def add(self, path: str, rule: tuple) -> None:
        self.rules[path] = rule
        if len(path) not in self.lengths:
            self.lengths.append(len(path))

    def fitting(self, path: str) -> Iterator[tuple]:
        for n in self.lengths:
            if n <= len(path) and (rule := self.rules.get(path[:n])):
                yield rule


def _sweep(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rules and urls in the order of block and key, a rule before the urls of its interval.

    The stack holds the active hosts, each nested in the one below; a key that does not begin
    with the top's key has left its interval.
    """
    stack: list[_Level] = []
    block = None
    for batch in batches:
        data = batch.to_pydict()
        rows, rules, verdicts = [], [], []
        for k, (at, key, is_url, path, rule, verdict) in enumerate(
            zip(*(data[c] for c in ("block", "key", "is_url", "path", "rule", "verdict")), strict=True)
        ):
            if at != block:
                stack, block = [], at
            while stack and not key.startswith(stack[-1].key):
                stack.pop()
            if not is_url:
                if not stack or stack[-1].key != key:
                    stack.append(_Level(key))
                stack[-1].add(path, (len(rule), verdict, rule))
                continue
            best = max((r for level in stack for r in level.fitting(path)), default=None)
            rows.append(k)
            rules.append(best and best[2])
            verdicts.append(best and best[1])
        kept = batch.take(pa.array(rows, pa.int64()))
        yield pa.record_batch(
            [kept.column("id"), kept.column("host"), kept.column("path"), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
            names,
        )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    blocks: int | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per page: ``id``, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``.  A rule fits its host and all subdomains
    where the path starts with the rule's; of those that fit, the longest ``host`` + ``path`` wins.  Of
    rules equal in host and path, ``block`` wins.  Where none fits, ``rule`` is null and
    the verdict is ``default``.

    Host labels are reversed, so all hosts of a domain are one interval of keys.  Urls and rules
    are dealt into blocks of neighbouring keys, a rule into each block that its interval meets,
    sorted, and swept once with a stack of active rules.  Edges come from a bounded sample of
    keys with a hash of the row after each, so one host, or one url, may fill many
    blocks; they decide balance only.

    A null url or one without ``://`` has empty host and path.  Null ids and repeated rows are
    kept.  Without rules every page gets the default; of an empty table the result is empty.
    Rules with a null host, path or verdict are passed over.  Other columns are not read.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_column))
    urls = pages.select(
        F.col(id_column).alias("id"), host.alias("host"), path.alias("path"),
        F.xxhash64(F.col(id_column), F.col(url_column)).alias("salt"),
    ).withColumn("key", host_key(F.col("host")))
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = pages.count()
    sampled = urls.select("key", "salt").sample(min(1.0, SAMPLE / max(total, 1)), seed=1).collect()
    keys = sorted((r.key, r.salt) for r in sampled)
    edges = sorted({keys[k * len(keys) // blocks] for k in range(1, blocks)}) if keys else []

    def block_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                bisect_right(edges, x)
                for x in zip(batch.column("key").to_pylist(), batch.column("salt").to_pylist(), strict=True)
            ]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.int32())], [*batch.schema.names, "block"])

    block_field = T.StructField("block", T.IntegerType())
    dealt = urls.mapInArrow(block_of, T.StructType([*urls.schema.fields, block_field]))
    known = (
        rules.dropna(subset=["host", "path", "verdict"])
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select("path", "verdict", F.concat("host", "path").alias("rule"), host_key(F.col("host")).alias("key"))
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places = [], []
            for k, key in enumerate(batch.column("key").to_pylist()):
                after = key[:-1] + chr(ord(key[-1]) + 1)  # the first key behind the interval
                for place in range(bisect_right(edges, (key, -(2**63))), bisect_right(edges, (after,)) + 1):
                    rows.append(k)
                    places.append(place)
            yield pa.record_batch(
                [*batch.take(pa.array(rows, pa.int64())).columns, pa.array(places, pa.int32())],
                [*batch.schema.names, "block"],
            )

    meeting = known.mapInArrow(spread, T.StructType([*known.schema.fields, block_field]))
    id_type = urls.schema["id"].dataType
    both = dealt.select(
        "block", "key", F.lit(True).alias("is_url"), "path", "id", "host",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
    ).unionByName(
        meeting.select(
            "block", "key", F.lit(False).alias("is_url"), "path", F.lit(None).cast(id_type).alias("id"),
            F.lit(None).cast("string").alias("host"), "rule", "verdict",
        )
    )
    names = ["id", "host", "path", "rule", "verdict"]
    schema = T.StructType(
        [T.StructField("id", id_type), *(T.StructField(n, T.StringType()) for n in names[1:])]
    )
    swept = (
        both.repartition(blocks, "block")
        .sortWithinPartitions("block", "key", "is_url")
        .mapInArrow(lambda batches: _sweep(batches, names), schema)
    )
    return swept.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
