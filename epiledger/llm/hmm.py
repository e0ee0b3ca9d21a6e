"""A hidden Markov language model over words."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiledger.sources.shared import as_table

STATES = 8
OWN = 4095  # words with a class of their own; class 0 is the end
SHARED = 4096  # classes of words by ending
CLASSES = 1 + OWN + SHARED
ROUNDS = 4
STRETCH = 1024  # tokens between two kept states of a long document
CELLS = 1 << 18  # tokens of documents that move in step
KEPT = 1 << 20  # tokens whose forward vectors a task keeps; of more it computes them again
BLOCK_BYTES = 16 << 20
SHRINKS = tuple(2.0**k for k in range(-1, 11))  # occurrences that the states of a word's class may count as
LN10 = math.log(10)


def ending_class(word: bytes) -> int:
    return 1 + OWN + zlib.crc32(word[-4:]) % SHARED


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


CRC = _crc_table()


def ending_classes(words: pa.BinaryArray) -> np.ndarray:
    """:func:`ending_class` of all words, by columns of bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    held = words.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held and held.size else np.zeros(1, np.uint8)
    ends, sizes = offsets[1:].astype(np.int64), np.diff(offsets)
    crc = np.full(len(words), 0xFFFFFFFF, np.uint32)
    for back in (4, 3, 2, 1):
        there = sizes >= back
        byte = data[np.where(there, ends - back, 0)]
        crc = np.where(there, CRC[(crc ^ byte) & np.uint32(0xFF)] ^ (crc >> np.uint32(8)), crc)
    return 1 + OWN + ((crc ^ np.uint32(0xFFFFFFFF)) % SHARED).astype(np.int64)


def _squeezed(places: np.ndarray) -> bytes:
    """32-bit numbers, bytes of equal weight side by side, compressed."""
    return pa.compress(places.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unsqueezed(raw: bytes, n: int) -> np.ndarray:
    whole = pa.decompress(raw, 4 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(whole, np.uint8).reshape(4, n).T).view("<i4").ravel()


def _blocks(docs: DataFrame) -> DataFrame:
    """Documents in blocks of some megabytes of text, each with a vocabulary of its own.

    Input columns: ``id``, ``held_out``, ``text``.  One row a block: its words, how often
    each occurs in training documents, and the documents as places in that vocabulary.
    """
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("words", T.ArrayType(T.BinaryType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
            T.StructField("ids", T.ArrayType(docs.schema["id"].dataType)),
            T.StructField("held", T.ArrayType(T.BooleanType())),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("places", T.BinaryType()),
        ]
    )
    id_type = T.StructType([docs.schema["id"]])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        id_arrow = to_arrow_schema(id_type).field(0).type
        number = TaskContext.get().partitionId() << 32
        ids, held, coded, taken = [], [], [], 0
        places = defaultdict(int)
        places.default_factory = places.__len__

        def row() -> pa.RecordBatch:
            words = list(places)
            train = [c for c, h in zip(coded, held, strict=True) if not h]
            counts = np.bincount(np.concatenate(train) if train else np.empty(0, np.int64), minlength=len(words))
            flat = _squeezed(np.concatenate(coded).astype("<i4"))
            values = [
                pa.array([number]), pa.array([words], pa.list_(pa.binary())),
                pa.array([counts], pa.list_(pa.int64())), pa.array([ids], pa.list_(id_arrow)),
                pa.array([held], pa.list_(pa.bool_())),
                pa.array([[len(c) for c in coded]], pa.list_(pa.int64())), pa.array([flat], pa.binary()),
            ]
            return pa.record_batch(values, schema.names)

        for batch in batches:
            for key, out, text in zip(*(batch.column(k) for k in range(3)), strict=True):
                raw = (text.as_py() or "").encode().lower().split()
                ids.append(key.as_py())
                held.append(out.as_py())
                coded.append(np.fromiter(map(places.__getitem__, raw), np.int64, len(raw)))
                taken += len(text.as_py() or "") + 64
                if taken >= BLOCK_BYTES:
                    yield row()
                    number, taken = number + 1, 0
                    ids.clear(), held.clear(), coded.clear(), places.clear()
        if ids:
            yield row()

    return docs.mapInArrow(gather, schema)


class Lexicon:
    """What training words say: totals, words with a class of their own, totals by ending."""

    def __init__(self, vocabulary: DataFrame, train_docs: int):
        totals = vocabulary.agg(F.sum("c"), F.count("c")).first()
        self.train_tokens = (totals[0] or 0) + train_docs
        self.distinct = totals[1] + (train_docs > 0)
        self.train_docs = train_docs
        top = vocabulary.orderBy(F.desc("c"), "word").limit(OWN).collect()
        self.own = {bytes(r.word): k for k, r in enumerate(top, 1)}
        self.class_tokens = np.zeros(CLASSES, np.int64)
        self.class_words = np.zeros(CLASSES, np.int64)
        ending = F.crc32(F.substring("word", -4, 4)) % SHARED
        for r in vocabulary.groupBy(ending.alias("e")).agg(F.sum("c").alias("n"), F.count("c").alias("v")).collect():
            self.class_tokens[1 + OWN + r.e], self.class_words[1 + OWN + r.e] = r.n, r.v
        for r, k in zip(top, self.own.values(), strict=True):
            shared = ending_class(bytes(r.word))
            self.class_tokens[shared] -= r.c
            self.class_words[shared] -= 1
            self.class_tokens[k] = r.c
        self.class_tokens[0] = train_docs

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.train_tokens + self.distinct + 1))

    def classes(self, words: pa.BinaryArray | list[bytes]) -> np.ndarray:
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
        if not len(words):
            return np.empty(0, np.int64)
        own = pc.fill_null(pc.index_in(words, value_set=pa.array(list(self.own), pa.binary())), -1).to_numpy()
        return np.where(own >= 0, own + 1, ending_classes(words))

    def within(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 P(word | class); one unseen word a class has the weight of one occurrence."""
        shared = np.log10((counts + 1) / (self.class_tokens[classes] + self.class_words[classes] + 1))
        return np.where(classes > OWN, shared, 0.0)


def class_mass(counts: np.ndarray, class_tokens: np.ndarray) -> np.ndarray:
    """Expected counts by state and class with 50 occurrences a state spread as in the corpus."""
    return counts + 50 * (class_tokens + 1.0) / (class_tokens.sum() + len(class_tokens))


class Model:
    """Start, transition and emission probabilities of the hidden states."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit
        self.by_word = np.ascontiguousarray(emit.T)
        self.single = tuple(np.ascontiguousarray(x, np.float32) for x in (start, move, self.by_word))

    @staticmethod
    def first(class_tokens: np.ndarray, states: int, seed: int = 7) -> Model:
        """States that linger and emit classes as the corpus does, each off by its own noise."""
        rng = np.random.default_rng(seed)
        emit = (class_tokens + 1.0) * np.exp(rng.normal(0, 1, (states, len(class_tokens))))
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return Model(np.full(states, 1 / states), move, emit / emit.sum(1, keepdims=True))

    @staticmethod
    def of_counts(counts: np.ndarray, class_tokens: np.ndarray) -> Model:
        """Maximises the expected counts ``[states, classes + states + 1]``, slightly smoothed."""
        states, n = len(counts), len(class_tokens)
        emit = class_mass(counts[:, :n], class_tokens)
        move = counts[:, n : n + states] + 1.0 / states
        start = counts[:, -1] + 1.0 / states
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    def log10_likelihood(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 probability of each sequence, by the scaled forward recursion.

        All sequences move in step, longest first, so each step is one product for those still
        running; memory is one state vector a sequence.
        """
        order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
        lengths = np.array([len(sequences[k]) for k in order])
        flat = np.concatenate([sequences[k] for k in order]) if order else np.empty(0, np.int64)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if order else lengths
        emit, total, alpha = self.by_word, np.zeros(len(order)), None
        running = np.searchsorted(-lengths, -np.arange(lengths.max(initial=0)), "left")
        for t, n in enumerate(running.tolist()):
            step = emit[flat[begin[:n] + t]]
            alpha = step * (self.start if t == 0 else alpha[:n] @ self.move)
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            total[:n] += np.log(scale)
        out = np.zeros(len(order))
        out[order] = total / LN10
        return out

    def _forward(self, sequences: list[np.ndarray], at: int, before: np.ndarray | None):
        """Scaled forward vectors of one stretch of sequences, longest first; ``before``: those at its eve."""
        start, move, by_word = self.single
        parts = [s[at : at + STRETCH] for s in sequences]
        lengths = np.array([len(p) for p in parts])
        classes = np.zeros((lengths[0], len(parts)), np.int64)
        for k, p in enumerate(parts):
            classes[: len(p), k] = p
        alive = np.arange(lengths[0])[:, None] < lengths
        step = by_word[classes]
        alpha, ones = np.empty_like(step), np.ones((len(start), 1), np.float32)
        if not alive[-1].all():
            step[~alive] = 0
            alpha[~alive] = 0
        come = start if before is None else before @ move
        for t, n in enumerate(alive.sum(1).tolist()):
            if t:
                come = alpha[t - 1, :n] @ move
            now = np.multiply(come, step[t, :n], out=alpha[t, :n])
            scale = 1 / (now @ ones)
            now *= scale
            step[t, :n] *= scale
        return classes, alive, step, alpha

    def expected_counts(self, sequences: list[np.ndarray], counts: np.ndarray) -> None:
        """Adds the expected emissions, moves and starts of the sequences (Baum-Welch).

        A long sequence is gone through by stretches: forwards, keeping the state at each one's end, then
        backwards.  A stretch's vectors are computed again from the state kept before it where ``KEPT`` tokens
        do not hold all, so memory is bounded and nothing is cut.  Vectors are scaled at every token
        and held in single precision, counts in double.
        """
        sequences = sorted(sequences, key=len, reverse=True)
        keep = sum(map(len, sequences)) <= KEPT
        eve, passes = None, []
        for at in range(0, len(sequences[0]), STRETCH):
            running = sequences[: sum(len(s) > at for s in sequences)]
            found = self._forward(running, at, eve)
            last = at + STRETCH >= len(sequences[0])
            passes.append((running, eve, found if keep or last else None))
            eve = found[3][-1, : sum(len(s) > at + STRETCH for s in sequences)].copy()
        after = np.zeros((0, len(self.start)), np.float32)
        while passes:
            running, eve, found = passes.pop()
            first = not passes
            found = found or self._forward(running, len(passes) * STRETCH, eve)
            after = self._count(*found, after, first, counts)

    def _count(self, classes, alive, step, alpha, after: np.ndarray, first: bool, counts: np.ndarray) -> np.ndarray:
        """Adds the counts of one stretch; ``after``: for those that go on, emission times what follows.

        Returns the same for the stretch before.
        """
        states, n_classes, go_on = len(self.start), self.emit.shape[1], len(after)
        back = np.ascontiguousarray(self.single[1].T)
        moves = alpha[-1, :go_on].T @ after
        beta, running = np.ones(alpha.shape[1:], np.float32), alive.sum(1).tolist()
        beta[:go_on] = after @ back
        gamma = alpha.copy()
        gamma[-1, :go_on] *= beta[:go_on]
        for t in range(len(step) - 2, -1, -1):
            n = running[t + 1]
            ahead = step[t + 1, :n]
            ahead *= beta[:n]
            np.matmul(ahead, back, out=beta[:n])
            gamma[t, :n] *= beta[:n]
        moves = moves + alpha[:-1].reshape(-1, states).T @ step[1:].reshape(-1, states)
        flat, of_state = classes, gamma.reshape(-1, states)
        if not alive[-1].all():
            flat, of_state = classes[alive], of_state[alive.ravel()]
        flat = flat.ravel()
        for k in range(states):
            counts[k, :n_classes] += np.bincount(flat, of_state[:, k], n_classes)
        counts[:, n_classes : n_classes + states] += self.move * moves
        if first:
            counts[:, -1] += gamma[0].sum(0)
        return step[0] * beta


class Emissions:
    """Emissions of single words, from expected counts by state of words and of classes.

    A word's occurrences, smoothed within its class, are dealt to the states as its own expected counts say and,
    with the weight of ``shrink`` occurrences, as its class says: rare words go by class, frequent ones by
    themselves, unseen ones by class alone.  ``totals`` are the sums over all words, so that each
    state's probabilities add up to one.
    """

    def __init__(self, lexicon: Lexicon, counts: np.ndarray):
        mass = class_mass(counts, lexicon.class_tokens)
        self.lexicon, self.of_class = lexicon, mass.sum(0)
        self.share = mass / self.of_class
        spread = mass - counts
        # Of each class, what its other occurrences say when one is held out.
        self.others = (spread + np.maximum(counts - 1, 0)) / np.maximum(self.of_class - 1, spread.sum(0))
        self.shrink, self.totals = SHRINKS[-1], mass.sum(1)

    def mass(self, classes: np.ndarray, c: np.ndarray, n: np.ndarray, shrink: float) -> np.ndarray:
        """Weights ``[states, words]`` of words with training counts ``c`` and expected counts ``n``."""
        tokens = self.of_class[classes] * 10 ** self.lexicon.within(classes, c)
        return tokens * (n + shrink * self.share[:, classes]) / (c + shrink)

    def fit(self, table: DataFrame) -> None:
        """Takes the ``shrink`` under which words of the table foretell their own states best.

        Each occurrence is held out in turn: its state is foretold from the other occurrences of the word and of
        the class.  One pass sums that, and the totals, for every candidate.
        """
        states = len(self.totals)

        def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(SHRINKS), states + 1))
            for batch in batches:
                classes = self.lexicon.classes(batch.column("word"))
                c = batch.column("c").to_numpy()
                n = batch.column("n").flatten().to_numpy().reshape(-1, states).T.astype(float)
                share = self.others[:, classes]
                for k, shrink in enumerate(SHRINKS):
                    others = np.log((np.maximum(n - 1, 0) + shrink * share) / (np.maximum(c - 1, 0) + shrink))
                    sums[k, 0] += (n * others).sum()
                    sums[k, 1:] += self.mass(classes, c, n, shrink).sum(1)
            for k, row in enumerate(sums.tolist()):
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([row], pa.list_(pa.float64()))], ["k", "sums"])

        found = table.mapInArrow(tried, "k int, sums array<double>").groupBy("k").agg(
            F.array(*[F.sum(F.col("sums")[j]) for j in range(states + 1)]).alias("sums")
        )
        sums = {r.k: r.sums for r in found.collect()}
        if sums:
            best = max(sums, key=lambda k: (sums[k][0], -k))
            self.shrink = SHRINKS[best]
            self.totals = np.array(sums[best][1:])
        else:
            self.totals = np.zeros(states)
        shared = np.arange(1 + OWN, CLASSES)
        unseen = self.mass(shared, np.zeros(len(shared), np.int64), np.zeros((states, len(shared))), self.shrink)
        self.totals += unseen.sum(1) + self.share[:, 0] * self.of_class[0]

    def over(self, model: Model, classes: np.ndarray, c: np.ndarray, n: np.ndarray) -> Model:
        """The model over words of a block; the end, which its class holds whole, is the last."""
        emit = self.mass(classes, c, n, self.shrink)
        emit[:, -1] = self.share[:, 0] * self.of_class[0]
        return Model(model.start, model.move, emit / self.totals[:, None])


def _texts(row: pa.RecordBatch, at: int) -> list[np.ndarray]:
    """The documents of a block as places in its vocabulary, with the end after each."""
    lengths = np.array(row.column("lengths")[at].as_py(), np.int64)
    flat = _unsqueezed(row.column("places")[at].as_py(), int(lengths.sum())).astype(np.int64)
    end = len(row.column("words")[at])
    return [np.append(t, end) for t in np.split(flat, np.cumsum(lengths)[:-1])]


def _in_step(sequences: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The sequences in groups of like length that move in step, each within ``CELLS``."""
    sequences = sorted(sequences, key=len, reverse=True)
    at = 0
    while at < len(sequences):
        many = max(CELLS // min(len(sequences[at]), STRETCH), 1)
        yield sequences[at : at + many]
        at += many


def baum_welch_round(
    blocks: DataFrame, model: Model, lexicon: Lexicon, by_word: bool
) -> tuple[Model, DataFrame, np.ndarray]:
    """One round over all training documents: the next model, and with ``by_word`` the table of expected counts.

    What a word adds within its class is the same in all states and has no say in which state it comes
    from, so a round needs the classes only, and no join.  Each task adds up its counts by class; those of single
    words leave it in the last round alone.
    """
    states = len(model.start)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros((states, CLASSES + states + 1))
        for batch in batches:
            for at in range(batch.num_rows):
                words = batch.column("words")[at].values
                classes = np.append(lexicon.classes(words), 0)
                over = Model(model.start, model.move, model.emit[:, classes])
                counts = np.zeros((states, len(classes) + states + 1))
                held = batch.column("held")[at].as_py()
                train = [t for t, out in zip(_texts(batch, at), held, strict=True) if not out]
                for group in _in_step(train):
                    over.expected_counts(group, counts)
                for k in range(states):
                    whole[k, :CLASSES] += np.bincount(classes, counts[k, : len(classes)], CLASSES)
                whole[:, CLASSES:] += counts[:, len(classes) :]
                if by_word:
                    own = batch.column("counts")[at].values.to_numpy()
                    seen = np.nonzero(own)[0]
                    # Of 2 ** -12 an occurrence nothing hangs; fewer bits are fewer bytes to shuffle.
                    n = np.rint(counts[:, seen].T * 4096) / 4096
                    yield rows(words.take(pa.array(seen)), None, own[seen], n)
        yield rows(None, np.arange(whole.shape[1]), None, whole.T)

    def rows(words, part, c, n: np.ndarray) -> pa.RecordBatch:
        none = [None] * len(n)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * states, pa.int32()), pa.array(n.ravel()))
        return pa.record_batch(
            [
                pa.array(none, pa.binary()) if words is None else words, pa.array(none if part is None else part, pa.int32()),
                pa.array(none if c is None else c, pa.int64()), flat,
            ],
            ["word", "part", "c", "n"],
        )

    sums = blocks.mapInArrow(expect, "word binary, part int, c bigint, n array<double>").groupBy("word", "part").agg(
        F.sum("c").alias("c"), F.array(*[F.sum(F.col("n")[k]) for k in range(states)]).alias("n")
    )
    if by_word:
        sums = as_table(sums.withColumn("n", F.col("n").cast("array<float>")), "hmm-expected")
    counts = np.zeros((states, CLASSES + states + 1))
    for r in sums.where("part is not null").collect():
        counts[:, r.part] = r.n
    words = sums.where("word is not null").select("word", "c", "n")
    return Model.of_counts(counts, lexicon.class_tokens), words, counts[:, :CLASSES]


def score_texts(
    docs: DataFrame,
    held_out,
    states: int = STATES,
    rounds: int = ROUNDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Scores every document by a hidden Markov model learned from those not held out.

    ``held_out`` is a boolean column over ``docs``.  Tokens are words with A-Z lowered and one
    end a document.  A state emits words: each training word by its own expected count in the state and that of
    its class, mixed as fits the corpus, unseen words by class; see :class:`Emissions`.  Each of the ``OWN`` most frequent words is a class, other words share one of ``SHARED`` by their
    last four bytes, and within a class words keep their share of its training tokens, an unseen word
    that of one occurrence.  Counts by word, and by state and word, are tables that grow with the
    vocabulary.  Each Baum-Welch round sums expected counts over all training documents, whole; the
    score is the exact log10 probability of the whole text by the scaled forward recursion.

    Documents lie in blocks of some megabytes.  For the scores alone the blocks look their vocabularies
    up in the count table, so neither the vocabulary nor a frequent word gathers in one task.

    Null texts count as empty: one end.  Rows with null ids and repeated rows count as
    documents.  With nothing to train on, all counts are 0 and the model is its starting
    guess.  Of an empty table the result is empty.  Other columns are not read.

    Columns: ``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``.
    """
    source = docs.select(
        F.col(id_column).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text_column).alias("text"),
    )
    blocks = as_table(_blocks(source), "hmm-blocks")
    occurring = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select("w.*").where("counts > 0")
    vocabulary = as_table(
        occurring.groupBy(F.col("words").alias("word")).agg(F.sum("counts").alias("c")), "hmm-words"
    )
    train_docs = blocks.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    lexicon = Lexicon(vocabulary, train_docs)
    model, table = Model.first(lexicon.class_tokens, states), vocabulary
    emissions = None
    for k in range(rounds if train_docs else 0):
        model, words, counts = baum_welch_round(blocks, model, lexicon, by_word=k == rounds - 1)
        if k == rounds - 1:
            table, emissions = words, Emissions(lexicon, counts)
            emissions.fit(table)
    id_field = T.StructField("id", blocks.schema["ids"].dataType.elementType)
    schema = T.StructType(
        [
            id_field, T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
        ]
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        words = left.column("words")[0].values
        counts, n = np.zeros(len(words) + 1, np.int64), np.zeros((states, len(words) + 1))
        place = right.column("place").to_numpy()
        counts[place] = right.column("c").to_numpy()
        counts[-1] = lexicon.train_docs
        classes = np.append(lexicon.classes(words), 0)
        if emissions is None:
            over = Model(model.start, model.move, model.emit[:, classes] * 10 ** lexicon.within(classes, counts))
        else:
            n[:, place] = right.column("n").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, states).T
            over = emissions.over(model, classes, counts, n)
        texts = _texts(left, 0)
        base = lexicon.base(counts)
        ids, held = (left.column(c).combine_chunks().flatten() for c in ("ids", "held"))
        return pa.table(
            [
                ids, held, pa.array([len(t) for t in texts], pa.int64()),
                pa.array([int((counts[t] > 0).sum()) for t in texts], pa.int64()),
                pa.array(np.full(len(texts), lexicon.train_tokens, np.int64)),
                pa.array([float(base[t].sum()) for t in texts], pa.float64()), pa.array(over.log10_likelihood(texts)),
            ],
            names=schema.names,
        )

    wanted = blocks.select(F.col("block").alias("of"), F.posexplode("words").alias("place", "word"))
    found = wanted.join(table, "word").drop("word")
    needed = blocks.select("block", "words", "ids", "held", "lengths", "places")
    return needed.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(score, schema)
