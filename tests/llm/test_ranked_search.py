"""Ranked search against plain scoring of every pair, with nulls, ties and repeated rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from epiledger.llm.ranked_search import Bucket, Query, Search, rank_documents, terms

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "doc_id long, text string, score long, item_id long, norm double"


def plain(docs, items, k=10):
    split = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in split)
    total = sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    found = []
    for item_id, text in set(items):
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scored = []
        for i, c in split:
            m = 25 + (75 * sum(c.values()) * n_docs) // total if total else 0
            score = sum(
                n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, n in asked.items() if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i))
        found += [(item_id, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=repr)


def found(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, 1, 1, 1.0) for i, t in docs], DDL).repartition(5)
    rows = rank_documents(d, spark.createDataFrame([(*r, 7) for r in items], "item_id long, text string, id long"), **more)
    return sorted([tuple(r) for r in rows.select("item_id", "rank", "id", "score").collect()], key=repr)


def corpus():
    dice = random.Random(5)
    words = [f"w{k}" for k in range(120)] + ["été", "naïve", "日本", "x\u0085y"]
    text = lambda n: " ".join(dice.choices(words, [1 / (k + 1) for k in range(len(words))], k=n))
    docs = [(k, text(dice.randrange(1, 60))) for k in range(300)]
    docs += [(1000 + k, docs[3][1]) for k in range(40)]  # ties
    docs += [(3, docs[3][1]), (3, docs[3][1]), (None, docs[5][1]), (None, None), (2000, None), (2001, ""), (2002, "!? --")]
    docs += [(2003, text(20_000)), (2004, "W1, w1;W2/é"), (2005, "w1" * 50_000)]
    items = [(k, text(12)) for k in range(25)]
    items += [(1, "w3 w3 w3"), (1, "w3 w3 w3"), (1, "other w4"), (None, "w5 w5"), (30, None), (31, ""), (32, "unheard of")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 22, 150])
def test_equals_scoring_of_all_pairs(spark, block_bytes):
    docs, items = corpus()
    items = [i for i in items if i[0] != 30]
    assert found(spark, docs, items, block_bytes=block_bytes) == plain(docs, items)


def test_empty_and_null_sides(spark):
    docs, items = [(1, "a b"), (2, "a c")], [(1, "a b"), (2, None)]
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []
    assert found(spark, [(1, None), (2, "")], items) == []
    assert found(spark, docs, items) == plain(docs, items[:1])


def test_terms_are_folded_in_ascii_only():
    text = "Grüße, ÉTÉ ABC_def-9\x00x\x7fy Ünï\u0085code 日本 K"
    assert [t.decode() for t in terms(text)] == TERM.findall(text.translate(LOWER))


def test_bounds_pass_over_vectors_and_lose_none():
    dice = np.random.default_rng(3)
    rows = [np.unique(dice.integers(0, 400, dice.integers(1, 40))) for _ in range(3000)]
    tf = [dice.integers(1, 4, len(r)) for r in rows]
    m = dice.integers(25, 900, len(rows))
    impact = [(10**9 * f) // (1000 * f + 8 * k) for f, k in zip(tf, m, strict=True)]
    norms = np.array([math.sqrt(float((i.astype(float) ** 2).sum())) for i in impact])
    order = np.argsort(-norms)
    weight = dice.integers(1, 20_000, 400).tolist()
    queries = [Query.of(Counter(rows[k].tolist()), weight) for k in range(50, 70)]
    search = Search(queries, [1] * len(queries), 400, 10)
    for at in range(0, len(order), 256):
        part = order[at : at + 256]
        starts = np.cumsum([0, *[len(rows[v]) for v in part]])
        bucket = Bucket(m[part], norms[part], starts, np.concatenate([rows[v] for v in part]), np.concatenate([tf[v] for v in part]))
        search.see(bucket, part.tolist())
    for query, best in zip(queries, search.best, strict=True):
        dense = np.zeros(400, np.int64)
        dense[query.coordinates] = query.weights
        scores = sorted((-int((dense[r] * i).sum()), False, v) for v, (r, i) in enumerate(zip(rows, impact, strict=True)))
        assert best == [s for s in scores if s[0] < 0][:10]
    assert search.rescored < 0.5 * search.tried
