"""The pipeline's stages, by what each does to its own input, and the SQL twins."""

import itertools
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from epiledger.llm import queries, simhash
from epiledger.llm.common import read
from epiledger.llm.simhash import similar_texts
from verification.compare import _bag, connect

SMALL = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, item_id long"


def shingles(text, words=5):
    tokens = text.lower().split()
    return {tuple(tokens[k : k + words]) for k in range(max(len(tokens) - words + 1, 1))}


def alike_pairs(sets, least=0.8):
    """All pairs of that Jaccard similarity, by counting what each two texts share."""
    holders = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    common = Counter(p for ids in holders.values() for p in itertools.combinations(ids, 2))
    return [(a, b) for (a, b), n in common.items() if n >= least * (len(sets[a]) + len(sets[b]) - n)]


def test_near_copies_miss_at_most_one_pair_in_a_hundred(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect() if r.text}
    alike = alike_pairs({i: s for i, s in sets.items() if s})
    found = {r.id: r.component_id for r in similar_texts(docs).collect()}
    linked = sum(found[a] == found[b] for a, b in alike)
    assert len(alike) > 50 and linked >= 0.99 * len(alike)


def test_near_copies_meet_by_fingerprint_and_are_checked(spark, monkeypatch):
    """With no bands to meet in: fingerprints a few bits apart, of alike texts alone, leave one document."""
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(simhash, "with_company", lambda nodes: nodes.select("node").where("false"))
    monkeypatch.setattr(simhash, "met_at_pivots", lambda nodes, similarity: none)
    monkeypatch.setattr(simhash, "met_in_bands", lambda nodes, similarity: none)
    words = [f"w{k}" for k in range(400)]
    edits = [" ".join([*words[:k], "edited", *words[k + 1 :]]) for k in range(0, 400, 10)]
    near = [t for t in edits if 0 < (simhash.simhash(t) ^ simhash.simhash(" ".join(words))).bit_count() <= 3]
    again = "a b c " * 300  # its shingles decide the fingerprint, what follows decides the set
    loose = [again + " ".join(f"{side}{k}" for k in range(40)) for side in "xy"]
    assert near and (simhash.simhash(loose[0]) ^ simhash.simhash(loose[1])).bit_count() <= 3
    texts = [" ".join(words), *near, *loose, ""]
    docs = spark.createDataFrame([(k, t, None, None, 1, None, None) for k, t in enumerate(texts)], DDL)
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect()}
    assert kept == {0, *range(len(near) + 1, len(texts))}


def sent_exploded(df):
    """The lines of the plan that explode rows for a join that sends them to all nodes as they are."""
    found, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        name = line.lstrip(" :+-")
        depth = len(line) - len(name)
        above = [(d, n) for d, n in above if d < depth]
        names = [n for _, n in above]
        sent = max((k for k, n in enumerate(names) if n.startswith("BroadcastExchange")), default=None)
        if name.startswith("Generate") and sent is not None and not any("Aggregate" in n for n in names[sent:]):
            found.append(line)
        above.append((depth, name))
    return found


def test_near_copies_send_no_exploded_table(spark, monkeypatch):
    sent, store = {}, simhash.as_table

    def stored(df, name, **kept):
        sent[name] = sent_exploded(df)
        return store(df, name, **kept)

    monkeypatch.setattr(simhash, "as_table", stored)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join([*words[:k], "edited", *words[k + 1 :]]) for k in range(0, 300, 10)]
    docs = spark.createDataFrame(list(enumerate([*texts, *texts, "a b c", ""])), "doc_id long, text string")
    found = {r.id: r.component_id for r in similar_texts(docs).collect()}
    assert found == {**{k: 0 for k in range(60)}, 60: 60, 61: 61}
    assert {"similar-near", "similar-stars-met", "similar-stars", "similar-links-met", "similar-links"} <= set(sent)
    assert not any(sent.values()), {n: lines for n, lines in sent.items() if lines}


def test_scratch_of_near_copies_goes(spark):
    place = spark._jvm.org.apache.hadoop.fs.Path(simhash.as_table(spark.range(1), "probe").inputFiles()[0]).getParent().getParent()
    there = lambda: {f.getPath().getName() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)}
    before = there()
    docs = spark.range(20).select(F.col("id").alias("doc_id"), F.lit("one two three four five six").alias("text"))
    found = similar_texts(docs)
    assert {n.rsplit("-", 1)[0] for n in there() - before} == {"similar-prints", "similar-classes"}
    assert {r.component_id for r in found.collect()} == {0}


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_twin(spark, name):
    cursor = connect(SMALL).execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    found = queries.QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == sorted(columns)
    assert _bag(found.columns, [tuple(r) for r in found.collect()]) == _bag(columns, cursor.fetchall())


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        rows[name] = docs.collect()
    before = spark.read.parquet(f"{SMALL}/documents.parquet").columns
    assert all(list(rows[n][0].__fields__) == before for n in list(rows)[:-1])
    texts = {r.doc_id: r.text for r in rows["boilerplate"]}
    sets = {i: shingles(t) for i, t in texts.items()}
    group = {i: i for i in texts}
    alike = alike_pairs(sets)
    for a, b in alike:
        old, new = max(group[a], group[b]), min(group[a], group[b])
        group = {i: new if g == old else g for i, g in group.items()}
    singles = {r.doc_id for r in rows["near_copies"]}
    assert alike and singles == set(group.values()) and len(singles) == len(rows["near_copies"])
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in rows["near_copies"] if any(i in r.text for i in items)}
    kept = {r.doc_id for r in rows["benchmarks"]}
    assert leaked and not leaked & kept
    assert {r.doc_id for r in rows["sequences"]} == kept


def test_stages_keep_columns_and_take_nulls(spark):
    text = "The cat sat on the mat and it was a fine day for all of them in the house"
    rows = [
        (1, text, "en", "a", 1, "mine", 7), (2, text, "en", "b", 1, None, None), (2, text, "en", "b", 1, None, None),
        (None, None, None, None, None, None, None), (3, "", "en", None, None, None, None),
        (None, "Le chat est sur le tapis et il fait beau pour nous tous", "fr", "c", None, None, None),
    ]
    docs = spark.createDataFrame(rows, DDL)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SMALL)
        assert found.columns == docs.columns, name
        kept = Counter(r.doc_id for r in found.collect())
        if name == "language":
            assert kept == Counter({1: 1, 2: 2, None: 1})
        if name == "near_copies":
            assert kept == Counter({1: 1, 3: 1, None: 1})
        if name in ("boilerplate", "benchmarks"):
            assert sum(kept.values()) == len(rows)


def test_language_stage_keeps_texts_of_an_unlabelled_table(spark):
    rows = [
        (1, "The cat sat", None, "a", 1, None, None), (1, "The cat sat", None, "a", 1, None, None),
        (2, "123 _ !!", None, "a", 1, None, None), (3, "", None, None, None, None, None),
        (4, None, None, None, None, None, None), (None, "猫", None, None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, DDL)
    found = corpus_pipeline.language(spark, docs, SMALL)
    assert found.columns == docs.columns
    assert Counter(r.doc_id for r in found.collect()) == Counter({1: 2, None: 1})
