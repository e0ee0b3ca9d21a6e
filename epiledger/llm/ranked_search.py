"""Exact ranked retrieval over norm buckets of impact vectors."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epiledger.sources.shared import as_table

BLOCK_BYTES = 4 << 20  # text of the items handled in one pass over the documents
BUCKET = 4096  # vectors in a bucket
FOCUS = 0.98  # share of a query's squared length that its focus coordinates hold
SEEDS = 0.02  # share of the longest vectors from which the first thresholds come
SLACK = 1 + 1e-9  # bounds are doubles, scores integers

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of characters beyond ASCII; only A-Z lower-cased."""
    return text.encode().translate(_FOLD).split() if text else []


@dataclass
class Query:
    """An item as a vector of integer weights, heaviest coordinates first."""

    coordinates: np.ndarray
    weights: np.ndarray
    length: float
    focus: int  # so many coordinates come first
    rest: float  # length of the others

    @classmethod
    def of(cls, counts: Counter[int], weight: list[int]) -> Query:
        held = sorted(((n * weight[t], t) for t, n in counts.items() if weight[t] > 0), reverse=True)
        weights = np.array([w for w, _ in held], np.int64)
        squares = np.cumsum(weights.astype(np.float64) ** 2)
        whole = float(squares[-1]) if held else 0.0
        focus = min(int(np.searchsorted(squares, FOCUS * whole)) + 1, len(held))
        rest = math.sqrt(float((weights[focus:].astype(np.float64) ** 2).sum()))
        return cls(np.array([t for _, t in held], np.int64), weights, math.sqrt(whole), focus, rest)


class Bucket:
    """Impact vectors of similar length: postings by coordinate and by vector."""

    def __init__(self, m: np.ndarray, norms: np.ndarray, starts: np.ndarray, coordinate: np.ndarray, tf: np.ndarray):
        sizes = np.diff(starts)
        self.n, self.norms, self.starts, self.coordinate = len(norms), norms, starts, coordinate
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes))
        order = np.argsort(coordinate, kind="stable")
        self.sorted = coordinate[order]
        self.vector = np.repeat(np.arange(self.n), sizes)[order]
        self.by_coordinate = self.impact[order].astype(np.float64)
        begin = np.nonzero(np.append(True, self.sorted[1:] != self.sorted[:-1]))[0] if len(order) else order
        self.greatest = np.zeros(len(order))  # at a coordinate's first posting
        if len(order):
            self.greatest[begin] = np.maximum.reduceat(self.by_coordinate, begin)

    def survivors(self, query: Query, least: float) -> np.ndarray:
        """Vectors whose score can reach ``least``.

        On the focus coordinates the product is known.  On the others it is at most the query's remaining
        length times the vector's, and at most the weights times the greatest impacts of the bucket.
        """
        first = np.searchsorted(self.sorted, query.coordinates)
        sizes = np.searchsorted(self.sorted, query.coordinates, "right") - first
        met = sizes[query.focus :] > 0
        others = np.dot(query.weights[query.focus :][met], self.greatest[first[query.focus :][met]])
        first, sizes = first[: query.focus], sizes[: query.focus]
        rows = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
        value, vector = self.by_coordinate[rows], self.vector[rows]
        known = np.bincount(vector, value * np.repeat(query.weights[: query.focus], sizes), self.n)
        used = np.bincount(vector, value * value, self.n)
        bound = known + np.minimum(query.rest * np.sqrt(np.maximum(self.norms**2 * SLACK - used, 0)), others)
        return np.nonzero((bound > 0) & (bound * SLACK >= least))[0]

    def scores(self, vectors: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact integer scores."""
        first, sizes = self.starts[vectors], self.starts[vectors + 1] - self.starts[vectors]
        begin = np.cumsum(sizes) - sizes
        rows = np.arange(sizes.sum()) + np.repeat(first - begin, sizes)
        return np.add.reduceat(dense[self.coordinate[rows]] * self.impact[rows], begin)


def _best(found: list[tuple], k: int) -> list[tuple]:
    """The first k of (-score, whether the id is null, id)."""
    return sorted(found)[:k]


class Search:
    """Finds, of the vectors it sees, each query's k best that reach the query's threshold."""

    def __init__(self, queries: list[Query], least: list[int], size: int, k: int):
        self.queries, self.least, self.k = queries, least, k
        self.best: list[list[tuple]] = [[] for _ in queries]
        self.lengths = np.array([q.length for q in queries])
        self.now = np.array(least, np.float64)
        self.dense = np.zeros(size, np.int64)
        self.tried = self.rescored = 0

    def see(self, bucket: Bucket, ids: list) -> None:
        reach = self.lengths * bucket.norms.max() * SLACK
        for q in np.nonzero((reach > 0) & (reach >= self.now))[0].tolist():
            query = self.queries[q]
            self.tried += bucket.n
            vectors = bucket.survivors(query, self.now[q])
            if not len(vectors):
                continue
            self.rescored += len(vectors)
            self.dense[query.coordinates] = query.weights
            scores = bucket.scores(vectors, self.dense)
            self.dense[query.coordinates] = 0
            good = np.nonzero((scores > 0) & (scores >= self.now[q]))[0]
            if len(good) > self.k:  # no score below the k-th of these can stay
                good = good[scores[good] >= np.partition(scores[good], -self.k)[-self.k]]
            if not len(good):
                continue
            new = [(-s, ids[v] is None, ids[v]) for s, v in zip(scores[good].tolist(), vectors[good].tolist(), strict=True)]
            self.best[q] = _best(self.best[q] + new, self.k)
            if len(self.best[q]) == self.k:
                self.now[q] = max(self.now[q], -self.best[q][-1][0])


def _found_terms(docs: DataFrame, vocabulary: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """(id, n, terms, tfs): how many terms a text has, and those of the vocabulary."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in batches:
            sizes, starts, held, times = [], [0], [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                own, tf = np.unique(np.array([t for t in map(get, words) if t is not None], np.int32), return_counts=True)
                sizes.append(len(words))
                held.append(own)
                times.append(tf.astype(np.int32))
                starts.append(starts[-1] + len(own))
            flat = lambda parts: pa.array(np.concatenate(parts) if parts else np.empty(0, np.int32))
            place = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(place, flat(held)), pa.ListArray.from_arrays(place, flat(times)),
                ],
                ["id", "n", "terms", "tfs"],
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(count, f"id {kind}, n long, terms array<int>, tfs array<int>")


def _searched(vectors: DataFrame, queries: list[Query], least: list[int], size: int, k: int) -> DataFrame:
    """(query, id, score): per task and query, up to k vectors that reach the query's threshold."""
    sent = vectors.sparkSession.sparkContext.broadcast((queries, least, size))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least, size = sent.value
        seen = Search(queries, least, size, k)
        schema = None
        for whole in batches:
            schema = whole.schema
            for at in range(0, whole.num_rows, BUCKET):
                batch = whole.slice(at, BUCKET)
                norms = batch.column("norm").to_numpy()
                if (seen.lengths * norms.max() * SLACK < seen.now).all():
                    continue
                held, tf = batch.column("terms"), batch.column("tfs")
                starts = held.offsets.to_numpy().astype(np.int64)
                bucket = Bucket(
                    batch.column("m").to_numpy(), norms, starts - starts[0],
                    held.flatten().to_numpy().astype(np.int64), tf.flatten().to_numpy().astype(np.int64),
                )
                seen.see(bucket, batch.column("id").to_pylist())
        if schema is None:
            return
        rows = [(q, i, -s) for q, best in enumerate(seen.best) for s, _, i in best]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], schema.field("id").type), pa.array(columns[2], pa.int64())],
            ["query", "id", "score"],
        )

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "m", "terms", "tfs", "norm").mapInArrow(search, f"query int, id {kind}, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` documents of highest score for each item: (item_id, rank, id, score).

    A document is a vector of impacts over the items' terms, an item one of weights; the score is their
    product, in integers.  Vectors are dealt by falling length, so neighbours form buckets.  The
    longest are searched first, which gives each item a threshold that its k-th score reaches.  Then
    a bucket is passed over for an item where the product of lengths (Cauchy-Schwarz) stays below the
    threshold; inside, the item's heaviest coordinates are multiplied out and the rest bounded by
    lengths; what survives is scored exactly.  No document that could be among the best is lost.

    Items come in blocks of ``block_bytes`` of text, each one search over all documents, so what is sent to the
    tasks or fetched to the driver (terms of a block, their document counts, thresholds) is bounded by
    the block or by one longer item, whatever the documents weigh.

    Equal scores go by ascending id, null ids last.  Every row of ``docs`` is a document of its own, repeated
    rows too.  Items equal in id and text count once; others with the same id are ranked apart under it.
    Null, empty and termless items and documents have no score above 0 and do not appear; an empty table
    on either side gives an empty result.  Texts are read whole.  Other columns are not read.
    """
    spark = docs.sparkSession
    source = items.select(F.col(item_id_column).alias("item_id"), F.col(item_text_column).alias("text"))
    source = source.where("text IS NOT NULL").distinct()
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    results = []
    for block in range(blocks):
        rows = source.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        counts = [Counter(terms(r.text)) for r in rows]
        vocabulary = {t: n for n, t in enumerate(sorted({t for c in counts for t in c}))}
        found = as_table(_found_terms(docs, vocabulary, id_column, text_column), "search-terms")
        whole = found.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        n_docs, n_terms = whole[0], whole[1] or 0
        holding = [0] * len(vocabulary)
        for term, n in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            holding[term] = n
        weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in holding]
        queries = [Query.of(Counter({vocabulary[t]: n for t, n in c.items()}), weight) for c in counts]

        impact = "(1000000000 * cast(tf AS bigint)) div (1000 * cast(tf AS bigint) + 8 * m)"
        vectors = (
            found.where(F.size("terms") > 0)
            .withColumn("m", F.expr(f"25 + (75 * n * {n_docs}L) div {max(n_terms, 1)}L"))
            .withColumn(
                "norm",
                F.expr(f"sqrt(aggregate(transform(tfs, tf -> {impact}), 0D, (total, x) -> total + cast(x AS double) * x))"),
            )
            .withColumn("spread", F.xxhash64("id"))
        )
        order = [F.col("norm").desc(), "spread"]
        vectors = as_table(
            vectors.repartitionByRange(*order).sortWithinPartitions(*order).drop("spread", "n"), "search-vectors"
        )
        cut = vectors.agg(F.percentile_approx("norm", 1 - SEEDS, 1000)).first()[0] or 0.0
        least = [1] * len(queries)
        seeds = as_table(
            _ranked(_searched(vectors.where(F.col("norm") >= cut), queries, least, len(vocabulary), k), k), "search-seeds"
        )
        for query, score in seeds.where(F.col("rank") == k).select("query", "score").collect():
            least[query] = score
        rest = _searched(vectors.where(F.col("norm") < cut), queries, least, len(vocabulary), k)
        best = _ranked(seeds.drop("rank").unionByName(rest), k)
        names = spark.createDataFrame(
            [(q, r.item_id) for q, r in enumerate(rows)], f"query int, item_id {source.schema['item_id'].dataType.simpleString()}"
        )
        results.append(best.join(names, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score"))
    first, *others = results
    for other in others:
        first = first.unionByName(other)
    return first
