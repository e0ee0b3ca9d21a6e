"""Language mixtures against all subsets of languages, and tiling against a plain tiler over a whole table."""

import itertools

import numpy as np

from epiledger.llm.common import in_fold, read
from epiledger.llm.decontam import decontaminate, tokens
from epiledger.llm.langid import grams, learn

SMALL, FOLD = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- language ----------------------------------------------------------------


def plain_mixture(p, n, kept, rounds=300):
    """Shares and log-likelihood of the languages kept, by plain expectation-maximisation."""
    shares = np.array([1.0 if k in kept else 0.0 for k in range(p.shape[1])]) / len(kept)
    for _ in range(rounds):
        parts = p * shares
        parts /= parts.sum(1, keepdims=True)
        shares = (parts * n[:, None]).sum(0) / n.sum()
    return shares, float((n * np.log((p * shares).sum(1))).sum())


def best_of_all_sets(languages, text):
    """The set of languages of least cost among all, each fitted to the end."""
    buckets, n = np.unique(grams(text), return_counts=True)
    p, cost = np.exp(languages.log_p[buckets]), 1.5 * np.log(n.sum() + 1)
    kinds = range(len(languages.names))
    fitted = []
    for size in range(1, len(languages.names) + 1):
        for kept in itertools.combinations(kinds, size):
            shares, like = plain_mixture(p, n.astype(float), kept)
            fitted.append((like - size * cost, shares))
    shares = max(fitted, key=lambda f: f[0])[1]
    return languages.names[shares.argmax()], float(shares.max())


def test_mixtures_equal_the_best_of_all_sets(spark):
    docs = read(spark, FOLD, "documents")
    languages = learn(docs, ~in_fold("doc_id", 4))
    rows = [r for r in docs.where(in_fold("doc_id", 4)).collect() if r.text and r.lang]
    texts = [r.text for r in rows if 40 < len(r.text.split()) < 400][:40]
    mixed = [f"{a[: len(a) * 3 // 4]} {b[: len(b) // 4]}" for a, b in zip(texts, texts[7:], strict=False)]
    found, score = languages.predict(texts + mixed)
    agree, apart = 0, []
    for text, name, share in zip(texts + mixed, found, score, strict=True):
        best, expected = best_of_all_sets(languages, text)
        agree += best == name
        apart.append(abs(expected - share))
    assert agree >= 0.97 * len(found) and np.mean(np.array(apart) < 0.05) >= 0.9


def test_mixture_rounds_raise_the_likelihood(spark):
    languages = learn(read(spark, FOLD, "documents"), ~in_fold("doc_id", 4))
    rng = np.random.default_rng(4)
    p, n = np.exp(languages.log_p[rng.integers(0, len(languages.log_p), 50)]), rng.integers(1, 9, 50).astype(float)
    kinds = len(languages.names)
    even = np.full((1, kinds), 1 / kinds)
    likes = [languages._mixture(p, n, np.array([0]), even, k)[1][0] for k in range(6)]
    assert likes == sorted(likes)
    shares, like = plain_mixture(p, n, range(kinds), 5)
    assert np.isclose(likes[5], like) and np.allclose(languages._mixture(p, n, np.array([0]), even, 5)[0][0], shares)


# --- decontamination ---------------------------------------------------------


def plain_coverage(text, item, width=5):
    """Greedy string tiling word by word: the longest unmarked match first, the earliest of equals."""
    places = {}
    for b, w in enumerate(item):
        places.setdefault(w, []).append(b)
    in_text, in_item, covered = [False] * len(text), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for a, w in enumerate(text):
            if in_text[a]:
                continue
            for b in places.get(w, ()):
                n = 0
                while (
                    a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n]
                    and not in_text[a + n] and not in_item[b + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < width:
            return covered / len(item)
        in_text[a : a + n], in_item[b : b + n] = [True] * n, [True] * n
        covered += n


def test_contamination_equals_a_plain_tiler(spark):
    docs, items = read(spark, SMALL, "documents"), read(spark, SMALL, "benchmark")
    found = {r.doc_id: r for r in decontaminate(docs, items, 0.6).collect()}
    benchmark = {r.item_id: tokens(r.text) for r in items.collect()}
    seeds = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in benchmark.items()}
    hits = 0
    for row in docs.collect():
        words = tokens(row.text)
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        near = [i for i in sorted(benchmark) if own & seeds[i]]
        best = max(((plain_coverage(words, benchmark[i]), -i) for i in near), default=(0.0, 0))
        r = found[row.doc_id]
        assert r.contaminated == (best[0] >= 0.6)
        if r.contaminated:
            hits += 1
            assert (r.item_id, r.coverage) == (-best[1], best[0])
    assert hits
