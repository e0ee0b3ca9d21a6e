"""The language model: exact counts over long texts, probabilities that add up, gain on unseen texts."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from epiledger.llm import hmm
from epiledger.llm.common import in_fold, read
from epiledger.llm.hmm import Emissions, Lexicon, Model, score_texts

FOLD = "/root/testdata/sf0.01"


def some_model(states=3, classes=5):
    rng = np.random.default_rng(1)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    return Model(norm(rng.random(states)), norm(rng.random((states, states))), norm(rng.random((states, classes))))


@pytest.mark.parametrize("stretch", [1, 2, 3, 7])
def test_stretches_count_as_the_whole(monkeypatch, stretch):
    rng = np.random.default_rng(stretch)
    model, sequences = some_model(), [rng.integers(0, 5, n) for n in (1, 2, 3, 6, 7, 8, 14, 40, 40)]
    whole, cut = np.zeros((3, 9)), np.zeros((3, 9))
    model.expected_counts(sequences, whole)
    monkeypatch.setattr(hmm, "STRETCH", stretch)
    for group in hmm._in_step(sequences):
        model.expected_counts(group, cut)
    assert np.allclose(whole, cut, rtol=1e-4)  # vectors are in single precision
    assert np.isclose(whole[:, -1].sum(), len(sequences), rtol=1e-5) and np.isclose(whole[:, :5].sum(), sum(map(len, sequences)))
    assert np.isclose(whole[:, 5:8].sum(), sum(len(s) - 1 for s in sequences))


def test_emissions_of_all_words_add_up_to_one(spark):
    rng = np.random.default_rng(2)
    c = rng.integers(1, 30, hmm.OWN + 900)
    words = [(f"word{k}".encode(), int(n)) for k, n in enumerate(c)]
    lexicon = Lexicon(spark.createDataFrame(words, "word binary, c long"), 4)
    classes = lexicon.classes([w for w, _ in words])
    share = rng.random((3, len(c)))
    n = share / share.sum(0) * c
    counts = np.stack([np.bincount(classes, n[k], hmm.CLASSES) for k in range(3)])
    counts[:, 0] = [1, 2, 1]
    emissions = Emissions(lexicon, counts)
    table = [(w, t, n[:, k].tolist()) for k, (w, t) in enumerate(words)]
    emissions.fit(spark.createDataFrame(table, "word binary, c long, n array<double>"))
    assert emissions.shrink in hmm.SHRINKS
    shared = np.arange(1 + hmm.OWN, hmm.CLASSES)
    every = np.concatenate([classes, shared, [0]])  # known words, an unseen one a shared class, the end
    seen = np.concatenate([c, np.zeros(len(shared), int), [4]])
    over = emissions.over(some_model(), every, seen, np.hstack([n, np.zeros((3, len(shared) + 1))]))
    assert np.allclose(over.emit.sum(1), 1) and (over.emit > 0).all()


def test_words_within_classes_add_up_to_one(spark):
    words = [(b"one", 5), (b"two", 1), (b"thirteen", 2), (b"fourteen", 3)]
    lexicon = Lexicon(spark.createDataFrame(words, "word binary, c long"), 4)
    own = lexicon.classes([w for w, _ in words])
    assert sorted(own) == [1, 2, 3, 4] and (lexicon.within(own, np.array([5, 1, 2, 3])) == 0).all()
    unseen = lexicon.classes([b"unheard"])
    assert lexicon.within(unseen, np.array([0]))[0] == np.log10(1.0)


def test_classes_of_all_words_are_those_of_each():
    words = [b"", b"a", b"ab", b"abc", b"abcd", b"abcde", "\u00e9t\u00e9".encode(), b"\xff\x00\xff\x80", b"own", b"word" * 50]
    lexicon = Lexicon.__new__(Lexicon)
    lexicon.own = {b"own": 1, b"ab": 2}
    expected = [lexicon.own.get(w) or hmm.ending_class(w) for w in words]
    whole = pa.array([b"before", *words, b"after"], pa.binary())
    assert lexicon.classes(words).tolist() == lexicon.classes(whole.slice(1, len(words))).tolist() == expected
    assert lexicon.classes([]).tolist() == []


def test_unseen_texts_score_above_the_base(spark):
    scores = score_texts(read(spark, FOLD, "documents"), in_fold("doc_id", 7))
    held = scores.where("held_out AND n_tokens > 1").agg(
        (F.sum("score") / F.sum("n_tokens")).alias("score"), (F.sum("base_score") / F.sum("n_tokens")).alias("base"),
        F.avg((F.col("score") > F.col("base_score")).cast("double")).alias("better"),
    ).first()
    assert held.score >= -3.63 and held.base < -4.0 and held.better > 0.9
