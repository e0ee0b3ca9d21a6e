"""Operators against brute force, and their edge cases, on small tables."""

import base64
import hashlib
import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from epiledger.llm import queries
from epiledger.llm.decontam import decontaminate, tiles
from epiledger.llm.graph import components
from epiledger.llm.hmm import Model, score_texts
from epiledger.llm.langid import identify, learn
from epiledger.llm.lines import remove_boilerplate
from epiledger.llm.packing import pack, pack_lengths
from epiledger.llm.quality import judge
from epiledger.llm.sharding import longest_first, shard_by_size
from epiledger.llm.simhash import near_duplicates, near_links, simhash, similar_texts
from epiledger.llm.urlrules import judge_urls
from epiledger.llm.warc import captures, read_records, write_archives

DDL = "doc_id long, text string, lang string, source string, n_chars long, row_key string, size string"
LONG = " ".join(f"word{k % 997}" for k in range(30_000))
TOKENIZER = public_tokenizers.path(queries.TOKENIZER)


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, "The cat sat on the mat, it was a fine day for all of them", "en", "a", 1, "x", "y"),
        (2, "The cat sat on the mat, it was a fine day for all of them", "en", "b", 1, None, None),
        (2, "The cat sat on the mat, it was a fine day for all of them", "en", "b", 1, None, None),
        (3, "Le chat est sur le tapis et il fait beau pour nous tous ici", "fr", "a", 1, None, None),
        (4, "", "fr", None, None, None, None),
        (5, None, None, "a", None, None, None),
        (None, "Nameless row of text", "en", "c", None, None, None),
        (None, None, None, None, None, None, None),
        (6, LONG, "en", "a", None, None, None),
        (7, "123 456 !!", None, "c", None, None, None),
        (8, "a\n\nSubscribe now\n b ", "en", "a", None, None, None),
        (9, "Subscribe now\nc", "en", "b", None, None, None),
        (10, " Subscribe now\t\nd\nSubscribe now", "en", "c", None, None, None),
    ]
    return spark.createDataFrame(rows, DDL)


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_all_take_an_empty_table(spark, docs):
    none, pages = docs.limit(0), spark.createDataFrame([], "page_id long, url string, html string")
    bench = spark.createDataFrame([], "item_id long, text string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    for found in (
        shard_by_size(none), score_texts(none, F.lit(False)), judge(none), pack(none, TOKENIZER),
        identify(none, learn(none, F.lit(True))), decontaminate(none, bench), remove_boilerplate(none),
        near_duplicates(none), similar_texts(none), judge_urls(pages, rules),
    ):
        assert found.count() == 0
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, none, "").count() == 0


# --- sharding ----------------------------------------------------------------


def test_longest_first_takes_the_least_loaded_shard():
    placed = longest_first([(7, "a"), (5, "b"), (4, "c"), (4, "d"), (1, "e")], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_shards_hold_groups_and_slots_have_no_gaps(docs):
    found = shard_by_size(docs, 3).collect()
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts(docs))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == expected
    slots, groups = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        groups[r.group_key].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())


def test_shards_equal_plain_schedule_where_all_groups_are_alone(spark):
    df = spark.createDataFrame([(k, "x" * (k * 37 % 101)) for k in range(200)], "doc_id long, text string")
    found = shard_by_size(df, 4)
    loads = sorted(r[0] for r in found.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect())
    groups = Counter()
    for k in range(200):
        groups["x" * (k * 37 % 101)] += k * 37 % 101 + 8
    plain = longest_first([(n, hashlib.md5(t.encode()).hexdigest()) for t, n in groups.items()], 4)
    expected = Counter()
    for t, n in groups.items():
        expected[plain[hashlib.md5(t.encode()).hexdigest()]] += n
    assert max(loads) - min(loads) <= max(expected.values()) - min(expected.values()) + 8


# --- language model ----------------------------------------------------------


def test_forward_and_expected_counts_equal_all_paths():
    rng = np.random.default_rng(1)
    norm = lambda x: x / x.sum(-1, keepdims=True)
    model = Model(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 5))))
    sequences = [np.array(s) for s in ([0, 2, 4, 1], [3], [1, 1])]
    counts = np.zeros((3, 5 + 3 + 1))
    model.expected_counts(sequences, counts)
    expected, logs = np.zeros_like(counts), []
    for s in sequences:
        weights = {}
        for path in itertools.product(range(3), repeat=len(s)):
            p = model.start[path[0]] * model.emit[path[0], s[0]]
            for t in range(1, len(s)):
                p *= model.move[path[t - 1], path[t]] * model.emit[path[t], s[t]]
            weights[path] = p
        total = sum(weights.values())
        logs.append(math.log10(total))
        for path, p in weights.items():
            expected[path[0], -1] += p / total
            for t, k in enumerate(path):
                expected[k, s[t]] += p / total
                if t:
                    expected[path[t - 1], 5 + k] += p / total
    assert np.allclose(counts, expected, rtol=1e-4, atol=1e-6)
    assert np.allclose(model.log10_likelihood(sequences), logs)


def test_base_scores_equal_counts(docs):
    held = F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False))
    found = score_texts(docs, held, rounds=1).collect()
    train, rows = Counter(), []
    for i, t in texts(docs):
        words = [*(t or "").encode().lower().split(), None]
        out = i is not None and i % 3 == 0
        rows.append((i, out, words))
        train.update([] if out else words)
    n, v = sum(train.values()), len(train)
    expected = Counter(
        (i, out, len(w), sum(train[x] > 0 for x in w), n, round(sum(math.log10((train[x] + 1) / (n + v + 1)) for x in w), 6))
        for i, out, w in rows
    )
    assert Counter((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    assert all(r.score < 0 for r in found)


def test_nothing_to_train_on(docs):
    found = score_texts(docs, F.lit(True), rounds=1).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in found} == {(0, 0, 0.0)}


# --- quality -----------------------------------------------------------------


def test_measures_equal_brute_force(docs):
    def measures(t):
        words = (t or "").encode().split()
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        often = {w for w, n in Counter(windows).items() if n > 1}
        covered = {k + d for k, w in enumerate(windows) if w in often for d in range(3)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        symbols = sum((t or "").count(c) for c in "#*$%&|<>")
        return len(words), sum(len(w.decode()) for w in words), symbols, len(lines) - len(set(lines)), len(covered)

    found = judge(docs)
    expected = Counter((i, *measures(t)) for i, t in texts(docs))
    columns = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == expected
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


# --- language ----------------------------------------------------------------


def test_languages_are_told_apart(spark, docs):
    found = {r.doc_id: r for r in identify(docs, learn(docs, F.lit(True))).collect()}
    assert found[1].lang_pred == "en" and found[3].lang_pred == "fr"
    assert {found[k].lang_pred for k in (4, 5, 7)} == {"und"}
    assert found[1].row_key == "x" and all(0 <= r.score <= 1 for r in found.values())


def test_held_out_accuracy(spark):
    found = queries.op4_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] >= 0.98


# --- urls --------------------------------------------------------------------


def test_rare_languages_are_learned_from_large_tables(spark):
    rows = [(k, f"some common words number {k}", "en") for k in range(4000)]
    rows += [(k, f"autant de mots {k}", "fr") for k in range(5000, 9000)] + [(k, f"harvinaiset sanat {k}", "fi") for k in range(9000, 9003)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = learn(df, F.lit(True), fit_rows=40)
    assert learned.names == ["en", "fi", "fr"]
    assert learned.predict(["harvinaiset sanat"])[0] == ["fi"]


def test_url_verdicts_equal_all_rules(spark):
    urls = [
        None, "", "no scheme", "http://a.org", "http://A.ORG/x", "https://example.org/es/1", "http://w.example.org/en/1?q",
        "http://example.org/en/2#/en/1", "http://notexample.org/es/", "ftp://x.com/fr/", "http://x.com/de/9", "http://com/de/", "://a.com/fr/",
        "http://example.org.com/de/x", "http://a.org/es/",
    ]
    pages = spark.createDataFrame([(k % 14, u, None) for k, u in enumerate(urls)] * 3, "page_id long, url string, host string")
    rules = spark.createDataFrame([*queries.URL_RULES, (None, "/", "block")], "host string, path string, verdict string")

    def judged(url):
        rest = url.partition("://")[2] if url and "://" in url else ""
        host = rest[: min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])]
        path = rest[len(host) :]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        host = host.lower()
        fits = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, "allow"))
        return host, path, rule, verdict

    for blocks in (1, 5):
        found = judge_urls(pages, rules, blocks=blocks).collect()
        assert Counter(tuple(r) for r in found) == Counter((k % 14, *judged(u)) for k, u in enumerate(urls) for _ in range(3))


# --- packing -----------------------------------------------------------------


def test_runs_fill_bins_without_gaps_and_large_items_pair():
    rng = np.random.default_rng(3)
    counts = Counter(rng.integers(1, 101, 3000).tolist()) + Counter({100: 50, 34: 7, 33: 9})
    bins = defaultdict(list)
    for length, _, n, first, each, offset in pack_lengths(counts, 100):
        for k in range(n):
            bins[first + k // each].append((offset + k % each * length, length))
    for items in bins.values():
        items.sort()
        assert items[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(items))
        assert sum(n for _, n in items) <= 100 and sum(3 * n > 100 for _, n in items) <= 2
    assert Counter(n for items in bins.values() for _, n in items) == counts
    assert len(bins) <= math.ceil(sum(k * n for k, n in counts.items()) / 100) * 1.02 + 1


def test_pieces_hold_the_tokenizers_ids(docs):
    found = pack(docs, TOKENIZER, 4096).collect()
    plain = Tokenizer.from_file(TOKENIZER)
    expected = Counter()
    for i, t in texts(docs):
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected[i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        items.sort()
        assert items[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(items))


def test_word_cache_equals_whole_texts():
    from epiledger.llm.packing import token_bytes

    odd = ["Don't STOP!! it's 3.14 <|endoftext|>x <|ENDOFTEXT|>", "É é ß x\xa0y…z", "a,b.c ''' 's"]
    plain = Tokenizer.from_file(TOKENIZER)
    for text, raw in zip(odd, token_bytes(odd, TOKENIZER), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_states_learn_words_beyond_the_most_frequent(spark):
    rng = np.random.default_rng(5)
    rows = [(1, " ".join(f"f{k}" for k in range(4095)) + " ")]
    rows = [(k, rows[0][1] * 2) for k in range(30)]
    for k in range(400):
        topic = "xy"[k % 2]
        rows.append((100 + k, " ".join([*(f"{topic}{n}" for n in rng.integers(0, 20, 40)), *(["p_end" if topic == "x" else "q_end"] if k % 20 < 2 else [])])))
    context = {t: " ".join(f"{t}{n}" for n in range(20)) for t in "xy"}
    rows += [(1000 + k, f"{context[t]} {w} {context[t]}") for k, (t, w) in enumerate(itertools.product("xy", ["p_end", "q_end"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    found = {r.id: r.score for r in score_texts(df, F.col("doc_id") >= 1000).where("id >= 1000").collect()}
    assert found[1000] > found[1001] + 0.05 and found[1003] > found[1002] + 0.05


# --- decontamination ---------------------------------------------------------


def test_tiles_never_overlap_and_longest_come_first():
    found = tiles([(10, 0, 0), (8, 5, 20), (6, 40, 4)], 3)
    assert found == [(10, 0, 0), (3, 10, 25)]


def test_leaks_are_found_in_any_order(spark, docs):
    item = " ".join(f"q{k}" for k in range(30))
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, "too short")], "item_id long, text string")
    words = item.split()
    rows = [
        (20, "before " + item.upper() + ", after"), (21, " ".join(words[15:] + ["x"] + words[:15])),
        (22, " ".join(words[:10])), (23, " ".join(reversed(words))), (24, None), (24, ""), (None, item + " " + LONG),
    ]
    df = spark.createDataFrame([(i, t, "old") for i, t in rows], "doc_id long, text string, coverage string")
    found = [(r.doc_id, r.contaminated, r.item_id) for r in decontaminate(df, bench).collect()]
    leaks = {20, 21, None}
    assert found == [(i, i in leaks, 1 if i in leaks else None) for i, _ in rows]


# --- lines -------------------------------------------------------------------


def test_shared_lines_stay_once(docs):
    found = {r.doc_id: r for r in remove_boilerplate(docs, 3).where("doc_id >= 4").collect()}
    assert [found[k].text for k in (8, 9, 10)] == ["a\n\nSubscribe now\n b ", "c", "d"]
    assert (found[10].n_lines, found[10].n_removed) == (3, 2)
    assert found[5].text is None and found[4].text == "" and found[6].text == LONG
    assert remove_boilerplate(docs, 3).count() == docs.count()


# --- archives ----------------------------------------------------------------


def test_archives_give_back_every_page(spark, tmp_path):
    rows = [
        (1, "http://a/x y", "same"), (5, "http://b", "same"), (3, None, "same"), (2, "http://c", None), (4, "http://d", ""),
        (6, "http://e", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\nünï\x00"), (7, "http://f", LONG),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    write_archives(pages, f"{tmp_path}/warc")
    found = captures(read_records(spark, f"{tmp_path}/warc")).collect()
    by_page = {int(r.metadata.fields.split()[1]): r for r in found}
    assert len(found) == len(by_page) == len(rows)
    last = {"same": 5, "": 4}
    for page_id, _, html in rows:
        r, raw = by_page[page_id], (html or "").encode()
        assert r.capture.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = last.get(html or "", page_id)
        assert r.capture.record_type == ("response" if first == page_id else "revisit")
        if first == page_id:
            assert bytes(r.capture.payload) == raw
        else:
            assert r.original.record_id == by_page[first].record_id and r.original.payload_bytes == len(raw)
        assert r.request.fields.startswith("GET /")


# --- near-duplicates ---------------------------------------------------------


def brute_simhash(text, words=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[k : k + words]) for k in range(max(len(w) - words + 1, 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_equal_plain_counts(docs):
    for _, t in texts(docs):
        for words in (3, 5):
            assert simhash(t, words) == brute_simhash(t, words)


def test_links_lose_no_pair(spark):
    rng = np.random.default_rng(5)
    prints = set()
    for base in rng.integers(0, 1 << 63, 40).tolist():
        for _ in range(10):
            flips = rng.choice(64, rng.integers(0, 5), replace=False).tolist()
            value = base ^ sum(1 << f for f in flips)
            prints.add(value - (1 << 64) if value >= 1 << 63 else value)
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    found = {(r.a, r.b) for r in near_links(df).collect()}
    mask = (1 << 64) - 1
    assert found == {(a, b) for a, b in itertools.permutations(prints, 2) if a < b and ((a ^ b) & mask).bit_count() <= 3}


def test_components_reach_along_chains(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, 102), (101, 102), (200, 200), (300, 301), (301, 300)]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(51)}, 100: 100, 101: 100, 102: 100, 300: 300, 301: 300}


def test_near_duplicates_equal_brute_force(spark):
    found = queries.op10_simhash(spark, "/root/testdata/sf0.001").collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    prints = {i: simhash(t) for i, t in docs}
    least = {i: i for i in prints}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = sorted((root(a), root(b)))
            least[y] = x
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {i: (f"{p:016x}", root(i)) for i, p in prints.items()}


def test_near_duplicates_send_no_lookups_and_no_documents(spark, docs):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    prints = spark.range(1000).select(F.xxhash64("id").alias("fingerprint"))
    assert "SortMergeJoin [s" in plan(near_links(prints)) and "Broadcast" not in plan(near_links(prints))
    found = near_duplicates(docs).select("id", "fingerprint", "component_id")
    assert "SortMergeJoin [fingerprint" in plan(found) and "Broadcast" not in plan(found)


def test_texts_without_words_are_linked(docs):
    found = near_duplicates(docs).where("fingerprint = 0").collect()
    assert {(r.id, r.component_id) for r in found} == {(4, 4), (5, 4), (None, 4)}


def test_similar_texts_link_edited_copies_only(spark):
    rng = np.random.default_rng(11)
    rows, other = [], 1000
    for k in range(30):
        words = [f"w{n}" for n in rng.integers(0, 3000, 200)]
        few, many = list(words), list(words)
        few[rng.integers(0, 200)] = "edited"
        many[::6] = ["edited"] * len(many[::6])
        rows += [(k, " ".join(words)), (k + 100, " ".join(few).upper()), (k + 200, " ".join(many)), (other + k, "")]
    found = {r.id: r.component_id for r in similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) == len(rows)
    for k in range(30):
        assert (found[k], found[k + 100], found[k + 200], found[other + k]) == (k, k, k + 200, other)


def test_similar_texts_edge_cases(docs):
    found = Counter((r.id, r.component_id) for r in similar_texts(docs).collect())
    assert found == Counter(
        {(1, 1): 1, (2, 1): 2, (3, 3): 1, (4, 4): 1, (5, 4): 1, (None, 4): 1, (None, None): 1}
        | {(k, k): 1 for k in range(6, 11)}
    )


def test_similar_texts_find_cut_and_extended_copies(spark):
    rng = np.random.default_rng(3)
    rows, pairs = [], []
    for k in range(150):
        words = [f"w{n}" for n in rng.integers(0, 3000, 200)]
        n = 200 - k % 3 * 16  # of 196 shingles all, 180 or 164 stay: 0.8 or more
        more = [*[f"h{n}" for n in rng.integers(0, 3000, 40)], *words]
        changed = {"cut": words[:n], "header cut": words[200 - n :], "extended": more}
        for j, (kind, other) in enumerate(changed.items(), 1):
            rows += [(10 * k, " ".join(words)), (10 * k + j, " ".join(other))]
            if kind != "extended" or 196 >= 0.8 * (len(other) - 4):
                pairs.append((10 * k, 10 * k + j))
    found = {r.id: r.component_id for r in similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(pairs) == 450
    assert sum(found[a] == found[b] for a, b in pairs) == 450


def test_similar_texts_do_not_link_below_the_similarity(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(100):
        words = [f"w{n}" for n in rng.integers(0, 3000, 204)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(words[:163]))]  # 159 of 200: 0.795
        rows += [(10 * k + 2, " ".join([*words[:150], "x", *words[151:]]))]
    found = {r.id: r.component_id for r in similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k in range(0, 1000, 10):
        assert (found[k], found[k + 1], found[k + 2]) == (k, k + 1, k)
