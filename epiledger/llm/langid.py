"""Language identification as inference of a mixture of languages."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiledger.llm.common import slices

BUCKETS = 1 << 16
UNKNOWN = "und"
_other = re.compile(r"[\W\d_]+")
_STRIDE = np.uint32(2654435761)


def grams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of the lower-cased words, one space between words."""
    words = _other.sub(" ", text.lower()).strip()
    if not words:
        return np.empty(0, np.int64)
    raw = np.frombuffer(f" {words} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return ((code * _STRIDE) >> np.uint32(16)).astype(np.int64)


class Languages:
    """Trigram log-probabilities by language, one column each."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        self.log_p = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * len(counts)))

    def _mixture(self, p: np.ndarray, n: np.ndarray, starts: np.ndarray, shares: np.ndarray, rounds: int):
        """Expectation-maximisation of the shares; returns them and the log-likelihoods.

        ``p``: probabilities of each gram of each document, ``n``: its count, ``starts``: where
        documents begin, ``shares``: first guess by document, 0 for languages left out.
        """
        sizes = np.diff(np.append(starts, len(n)))
        total = np.add.reduceat(n, starts)
        for _ in range(rounds):
            parts = p * np.repeat(shares, sizes, axis=0)
            parts *= (n / parts.sum(1))[:, None]
            shares = np.add.reduceat(parts, starts, axis=0) / total[:, None]
        mixed = (p * np.repeat(shares, sizes, axis=0)).sum(1)
        return shares, np.add.reduceat(n * np.log(mixed), starts)

    def predict(self, texts: list[str | None], rounds: int = 8) -> tuple[list[str], np.ndarray]:
        """The main language of each text and its share of the text.

        Penalised likelihood: a set of k languages costs ``k * log(grams) * 3 / 2``, three as
        neighbouring trigrams share bytes.  One language is right when even the mixture of all,
        at the cost of two, is no better; else languages are left out one by one, the least
        share first, as long as that lowers the criterion.
        """
        found = [UNKNOWN] * len(texts)
        score = np.zeros(len(texts))
        coded = []
        for k, text in enumerate(texts):
            buckets = grams(text) if text else ()
            if len(buckets) and self.names:
                coded.append((k, *np.unique(buckets, return_counts=True)))
        if not coded:
            return found, score
        rows = np.array([k for k, _, _ in coded])
        starts = np.cumsum([0] + [len(b) for _, b, _ in coded])[:-1]
        buckets = np.concatenate([b for _, b, _ in coded])
        n = np.concatenate([c for _, _, c in coded]).astype(float)
        log_p, kinds = self.log_p[buckets], len(self.names)
        p = np.exp(log_p)
        cost = 1.5 * np.log(np.add.reduceat(n, starts) + 1)
        single = np.add.reduceat(log_p * n[:, None], starts, axis=0)
        best = single.argmax(1)
        even = np.full((len(rows), kinds), 1 / kinds)
        shares, whole = self._mixture(p, n, starts, even, rounds)
        alone = single[np.arange(len(rows)), best]
        ends = np.append(starts[1:], len(n))
        for d, k in enumerate(rows.tolist()):
            found[k], score[k] = self.names[best[d]], 1.0
            if whole[d] - 2 * cost[d] <= alone[d] - cost[d]:
                continue
            at = slice(starts[d], ends[d])
            kept, like = shares[d].copy(), whole[d]
            while (kept > 0).sum() > 1:
                fewer = kept.copy()
                fewer[np.where(kept > 0, kept, 2).argmin()] = 0
                fewer, less = self._mixture(p[at], n[at], np.array([0]), fewer[None] / fewer.sum(), rounds)
                if less[0] < like - cost[d]:
                    break
                kept, like = fewer[0], less[0]
            found[k], score[k] = self.names[kept.argmax()], kept.max()
        return found, np.clip(score, 0.0, 1.0)


def rows_of_each(sizes: list[int], total: int) -> float:
    """The most rows to take of each group so that all take about ``total``, but 20 or more."""
    most = float(max(sizes, default=0))
    for k, n in enumerate(sorted(sizes)):
        if n * (len(sizes) - k) > total:
            most = max(total / (len(sizes) - k), 20.0)
            break
        total -= n
    return most


def learn(
    docs: DataFrame,
    usable: Column,
    fit_rows: int = 20_000,
    text_column: str = "text",
    lang_column: str = "lang",
    id_column: str = "doc_id",
) -> Languages:
    """Trigram counts by language, from about ``fit_rows`` of the usable labelled rows.

    All rows where there are no more than ``fit_rows``; else up to a number of each language, the same
    for all and as great as ``fit_rows`` allows, so a rare language is learned from all its rows.
    Rows are chosen by the hash of their id and text.  Rows without text or language are
    passed over.
    """
    labelled = docs.where(usable & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    sizes = dict(labelled.groupBy(lang_column).agg(F.count(F.lit(1))).collect())
    most = rows_of_each(list(sizes.values()), fit_rows)
    shares = docs.sparkSession.createDataFrame(
        [(lang, min(most / n, 1.0)) for lang, n in sizes.items()],
        T.StructType([T.StructField("_of", T.StringType()), T.StructField("_share", T.DoubleType())]),
    )
    chosen = F.pmod(F.xxhash64(id_column, text_column), F.lit(1 << 52)) < F.col("_share") * (1 << 52)
    rows = (
        labelled.select(id_column, text_column, lang_column)
        .join(F.broadcast(shares), F.col(lang_column) == F.col("_of")).where(chosen).select(text_column, lang_column)
    )

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(grams(text), minlength=BUCKETS)
        for lang, own in counts.items():
            seen = np.nonzero(own)[0]
            yield pa.record_batch(
                [pa.array([lang] * len(seen)), pa.array(seen.astype(np.int32)), pa.array(own[seen])],
                ["lang", "bucket", "n"],
            )

    sums = rows.mapInArrow(tally, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sums["lang"].to_pylist()
    names = sorted(set(langs))
    place = {name: k for k, name in enumerate(names)}
    counts = np.zeros((BUCKETS, len(names)))
    counts[sums["bucket"].to_numpy(), np.array([place[x] for x in langs], np.int64)] = sums["n"].to_numpy()
    return Languages(names, counts)


def lettered(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents whose text has a letter, by the same rule as in :func:`grams`."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_column)).to_pylist()
            yield batch.filter(pa.array([bool(t and _other.sub("", t)) for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def identify(
    docs: DataFrame,
    languages: Languages,
    text_column: str = "text",
    lang_name: str = "lang_pred",
    score_name: str = "score",
) -> DataFrame:
    """The documents with predicted language and score.

    Only the text is looked at, all of it.  A text that is null or has no letter is ``und`` with score 0.
    Columns of the two names are replaced; all other columns and rows, repeated ones
    too, stay as they are.  Of an empty table the result is empty.
    """
    source = docs.drop(lang_name, score_name)
    schema = T.StructType(
        source.schema.fields + [T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())]
    )

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_column, 1 << 18):
                found, score = languages.predict(batch.column(text_column).to_pylist())
                yield pa.record_batch([*batch.columns, pa.array(found, pa.string()), pa.array(score)], schema.names)

    return source.mapInArrow(tag, schema)
