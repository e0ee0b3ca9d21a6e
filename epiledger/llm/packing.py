"""Best-fit packing of token sequences, large items first."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiledger.llm.common import block_of_rows, numbered
from epiledger.sources.shared import as_table

END = 1
WORDS_KEPT = 1_000_000  # of a worker's cache; it starts anew beyond them
_tokenizers: dict[str, tuple] = {}


def _encoder(path: str):
    """The tokenizer of a file and its word cache, once for each worker."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path), {}
    return _tokenizers[path]


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text as little-endian 32-bit numbers.

    The vocabulary lower-cases and never joins across white space, so ids are looked up word by
    word, and only words not seen before are encoded, many in one call.  Words with the start
    of a special token keep their case.
    """
    tokenizer, known = _encoder(path)
    split = [
        [w if b"<|" in w else w.lower() for w in raw.split()] if b"<|" in raw else raw.lower().split()
        for raw in (t.encode() for t in texts)
    ]
    if len(known) > WORDS_KEPT:
        known.clear()
    new = list(set().union(*split).difference(known))
    for at in range(0, len(new), 4096):
        part = new[at : at + 4096]
        words = [w.decode() for w in part]
        coded = tokenizer.encode(" ".join(words), add_special_tokens=False)
        raw = np.array(coded.ids, "<u4").tobytes()
        first = np.array([a for a, _ in coded.offsets], np.int64)
        starts = np.cumsum([0] + [len(w) + 1 for w in words])
        cut = (4 * np.searchsorted(first, starts)).tolist()
        for k, word in enumerate(part):
            known[word] = raw[cut[k] : cut[k + 1]]
    return [b"".join(map(known.__getitem__, words)) for words in split]


def pieces_of(
    docs: DataFrame, tokenizer_path: str, capacity: int, id_column: str, text_column: str
) -> DataFrame:
    """Tokens of each document and an end, cut into pieces where longer than the capacity."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = T.StructType(
        [source.schema["id"]]
        + [T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = END.to_bytes(4, "little")
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows, pieces, starts, lengths, sums = [], [], [], [], []
                coded = token_bytes([t or "" for t in batch.column(1).to_pylist()], tokenizer_path)
                for k, raw in enumerate(coded):
                    raw += end
                    for piece, start in enumerate(range(0, len(raw) // 4, capacity)):
                        ids = raw[4 * start : 4 * (start + capacity)]
                        rows.append(k)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(len(ids) // 4)
                        sums.append(zlib.crc32(ids))
                columns = [batch.column(0).take(pa.array(rows, pa.int32()))]
                columns += [pa.array(c, pa.int64()) for c in (pieces, starts, lengths, sums)]
                yield pa.record_batch(columns, schema.names)

    return source.mapInArrow(cut, schema)


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go, as runs.

    A run ``(length, first, n, bin, each, offset)`` puts pieces ``first .. first + n - 1`` of a length,
    ``each`` to a bin, into bins ``bin, bin + 1, ...`` from the offset on.  All that is held are
    groups of bins filled alike, so the work follows the number of different lengths, not the
    number of pieces.

    Pieces above a third of the capacity come first, longest first: a bin holds at most two of
    them, and each is matched with the longest other one that fits.  Then the smaller ones, longest
    first, go where the least room remains that holds them, and into new bins when none does.
    """
    left = {length: n for length, n in counts.items() if n}
    used = defaultdict(int)
    runs, rooms, groups, bins = [], [], defaultdict(list), 0

    def opened(room: int, first: int, n: int) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append((first, n))

    def put(length: int, first: int, n_bins: int, each: int, offset: int) -> None:
        runs.append((length, used[length], n_bins * each, first, each, offset))
        used[length] += n_bins * each
        left[length] -= n_bins * each

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        length = large[-1]
        n = left[length]
        if not n:
            large.pop()
            continue
        k = bisect_left(large, capacity - length + 1) - 1
        while k >= 0 and not left[large[k]]:
            k -= 1
        mate = large[k] if k >= 0 else None
        if mate is None or (mate == length and n == 1 and k == 0):
            put(length, bins, n, 1, 0)
            opened(capacity - length, bins, n)
            bins += n
        elif mate == length:
            pairs = n // 2
            if pairs:
                put(length, bins, pairs, 2, 0)
                opened(capacity - 2 * length, bins, pairs)
                bins += pairs
            if left[length]:  # the odd one is matched with the next shorter length
                large.pop()
                k -= 1
                while k >= 0 and not left[large[k]]:
                    k -= 1
                put(length, bins, 1, 1, 0)
                if k >= 0:
                    put(large[k], bins, 1, 1, length)
                opened(capacity - length - (large[k] if k >= 0 else 0), bins, 1)
                bins += 1
        else:
            n = min(n, left[mate])
            put(length, bins, n, 1, 0)
            put(mate, bins, n, 1, length)
            opened(capacity - length - mate, bins, n)
            bins += n
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                n, rest = divmod(left[length], each)
                for n_bins, fill in ((n, each), (1, rest)):
                    if n_bins and fill:
                        put(length, bins, n_bins, fill, 0)
                        opened(capacity - fill * length, bins, n_bins)
                        bins += n_bins
                break
            room = rooms[at]
            first, n = groups[room].pop()
            if not groups[room]:
                rooms.pop(at)
            each = min(room // length, left[length])
            filled = min(n, left[length] // each)
            if filled < n:
                opened(room, first + filled, n - filled)
            put(length, first, filled, each, capacity - room)
            opened(room - each * length, first, filled)
    return runs


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece of a document: where it starts, its checksum, its sequence and offset.

    A document is its ids and one end id.  Only documents above the capacity are cut, at its
    multiples.  Sequences are planned by :func:`pack_lengths` from the number of pieces of each
    length, at most ``capacity`` numbers on any corpus; pieces are then numbered within their
    length and each finds its run.

    A null or empty text is one end id.  Repeated rows and null ids count as documents.  Of an
    empty table the result is empty.  Other columns are not read.

    Columns: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.
    """
    pieces = as_table(
        pieces_of(docs, tokenizer_path, capacity, id_column, text_column).withColumn(
            "_block", block_of_rows()
        ),
        "packing-pieces",
    )
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = np.array(pack_lengths(counts, capacity), np.int64).reshape(-1, 6)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    ranked = numbered(
        pieces, ["length"], [F.col("id"), F.col("start"), F.col("ids_crc32")], "_block", "rank"
    ).drop("_block")
    schema = T.StructType(
        [f for f in ranked.schema if f.name != "rank"]
        + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts = runs[:, 0], runs[:, 1]
        spans = {x: np.searchsorted(lengths, [x, x + 1]) for x in np.unique(lengths).tolist()}
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            run = np.empty(len(length), np.int64)
            for x in np.unique(length).tolist():
                low, high = spans[x]
                own = length == x
                run[own] = low + np.searchsorted(firsts[low:high], rank[own], "right") - 1
            _, first, _, bin_, each, offset = runs[run].T
            number, slot = np.divmod(rank - first, each)
            columns = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "rank"]
            columns += [pa.array(bin_ + number), pa.array(offset + slot * length)]
            yield pa.record_batch(columns, schema.names)

    return ranked.mapInArrow(place, schema)
