"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE = 0x9E3779B97F4A7C15
BLOCK_BYTES = 8 << 20
_word = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _word.findall(text.lower()) if text else []


def rolling(codes: np.ndarray, width: int) -> np.ndarray:
    """The Karp-Rabin value of each window; 64-bit arithmetic that wraps."""
    n = max(len(codes) - width + 1, 0)
    value = np.zeros(n, np.uint64)
    for k in range(width):
        value = value * np.uint64(BASE) + codes[k : k + n]
    return value


def tiles(matches: list[tuple[int, int, int]], shortest: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of maximal matches ``(length, start in text, start in item)``.

    The longest match is marked first, earlier ones first among equals.  A match that meets marked
    words is cut to its unmarked stretches, which wait their turn.  Tiles never overlap, in
    the text or in the item, but may come in any order.
    """
    waiting = [(-n, a, b) for n, a, b in matches]
    heapq.heapify(waiting)
    text_marks: set[int] = set()
    item_marks: set[int] = set()
    found = []
    while waiting:
        n, a, b = heapq.heappop(waiting)
        n = -n
        free = [a + k not in text_marks and b + k not in item_marks for k in range(n)]
        if all(free):
            text_marks.update(range(a, a + n))
            item_marks.update(range(b, b + n))
            found.append((n, a, b))
            continue
        start = None
        for k in range(n + 1):
            if k < n and free[k]:
                start = k if start is None else start
            elif start is not None:
                if k - start >= shortest:
                    heapq.heappush(waiting, (start - k, a + start, b + start))
                start = None
    return found


class Seeds:
    """The windows of a bounded set of benchmark items, by Karp-Rabin value."""

    def __init__(self, items: list[tuple[object, str]], width: int):
        self.width, self.vocabulary = width, {}
        self.ids, self.lengths = [], []
        values, owners, places = [], [], []
        for item_id, text in items:
            words = tokens(text)
            if len(words) < width:
                continue
            codes = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.uint64)
            own = rolling(codes, width)
            values.append(own)
            owners.append(np.full(len(own), len(self.ids)))
            places.append(np.arange(len(own)))
            self.ids.append(item_id)
            self.lengths.append(len(words))
        none = np.empty(0, np.int64)
        value = np.concatenate(values) if values else none.astype(np.uint64)
        order = np.argsort(value, kind="stable")
        self.owners = (np.concatenate(owners) if owners else none)[order]
        self.places = (np.concatenate(places) if places else none)[order]
        self.values, self.first, self.count = np.unique(value[order], return_index=True, return_counts=True)

    def matches(self, text: str | None) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """For each item with a shared window, the maximal matches with the text."""
        words = tokens(text)
        if len(words) < self.width or not len(self.values):
            return
        codes = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words))
        value = rolling(codes, self.width)
        known = np.lib.stride_tricks.sliding_window_view(codes > 0, self.width).all(1)
        at = np.nonzero(known)[0]
        slot = np.minimum(np.searchsorted(self.values, value[at]), len(self.values) - 1)
        hit = self.values[slot] == value[at]
        at, slot = at[hit], slot[hit]
        if not len(at):
            return
        times = self.count[slot]
        text_at = np.repeat(at, times)
        within = np.arange(len(text_at)) - np.repeat(np.cumsum(times) - times, times)
        row = np.repeat(self.first[slot], times) + within
        item, item_at = self.owners[row], self.places[row]
        order = np.lexsort((text_at, text_at - item_at, item))
        item, text_at, item_at = item[order], text_at[order], item_at[order]
        joined = (
            (item[1:] == item[:-1])
            & (text_at[1:] - item_at[1:] == text_at[:-1] - item_at[:-1])
            & (text_at[1:] == text_at[:-1] + 1)
        )
        begin = np.nonzero(np.append(True, ~joined))[0]
        length = np.diff(np.append(begin, len(item))) + self.width - 1
        item, text_at, item_at = item[begin].tolist(), text_at[begin].tolist(), item_at[begin].tolist()
        runs: list[tuple[int, int, int]] = []
        for k, n in enumerate(length.tolist()):
            runs.append((n, text_at[k], item_at[k]))
            if k + 1 == len(item) or item[k + 1] != item[k]:
                yield item[k], runs
                runs = []

    def best(self, text: str | None, least: float) -> tuple[float, object]:
        """The highest coverage of an item by tiles, and the item; ties go to the smaller id.

        Items whose matched words cannot reach ``least`` are not tiled.
        """
        found: tuple[float, object] = (0.0, None)
        for item, runs in self.matches(text):
            reached = np.zeros(self.lengths[item] + 1, np.int64)
            for n, _, b in runs:
                reached[b] += 1
                reached[b + n] -= 1
            if (np.cumsum(reached)[:-1] > 0).sum() < least * self.lengths[item]:
                continue
            covered = sum(n for n, _, _ in tiles(runs, self.width)) / self.lengths[item]
            if covered > found[0] or (covered == found[0] and found[1] is not None and self.ids[item] < found[1]):
                found = covered, self.ids[item]
        return found


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = 0.6,
    width: int = 5,
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    names: tuple[str, str, str] = ("contaminated", "item_id", "coverage"),
) -> DataFrame:
    """The documents with three more columns: whether a benchmark item leaks, which, how much.

    Seeds are windows of ``width`` words that a document shares with an item.  Runs of seeds are
    maximal matches; :func:`tiles` marks the longest first, so passages count in any order.  A
    document is contaminated if tiles cover ``coverage`` of some item's words; the item with the highest
    coverage is named, and null, with coverage 0, where none is reached.

    Benchmark items are sent to the tasks in blocks of some megabytes, one pass over a
    document for each, so neither side has to fit anywhere whole.  Equal item texts count
    once, under their smallest id.  Items of fewer than ``width`` words, null or empty ones
    never match, nor do null or empty documents.  Columns of the three names are replaced;
    other columns and all rows stay.  Without items nothing is contaminated; of an empty
    table the result is empty.
    """
    items = benchmark.select(
        F.col(item_id_column).alias("id"), F.col(item_text_column).alias("text")
    ).where("text is not null and id is not null").groupBy("text").agg(F.min("id").alias("id"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    flag, item_name, cover_name = names
    source = docs.drop(*names)
    item_field = T.StructField(item_name, benchmark.schema[item_id_column].dataType)
    schema = T.StructType([*source.schema.fields, item_field, T.StructField(cover_name, T.DoubleType())])
    marked = source.withColumn(item_name, F.lit(None).cast(item_field.dataType)).withColumn(cover_name, F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("id").collect()
        seeds = sent(Seeds([(r.id, r.text) for r in rows], width))

        def mark(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            item_type = to_arrow_schema(T.StructType([item_field])).field(0).type
            for batch in batches:
                ids = batch.column(item_name).to_pylist()
                covers = batch.column(cover_name).to_pylist()
                for k, text in enumerate(batch.column(text_column).to_pylist()):
                    cover, item = seeds.value.best(text, coverage)
                    if cover >= coverage and (-cover, item) < (-covers[k], item if ids[k] is None else ids[k]):
                        ids[k], covers[k] = item, cover
                yield pa.record_batch(
                    [*batch.columns[:-2], pa.array(ids, item_type), pa.array(covers, pa.float64())], schema.names
                )

        marked = marked.mapInArrow(mark, schema)
    return marked.withColumn(flag, F.col(item_name).isNotNull())
