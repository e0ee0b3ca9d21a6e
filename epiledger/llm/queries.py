"""The registered queries of this package, with production parameters, and their SQL twins."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiledger.llm.common import in_fold, read
from epiledger.llm.decontam import decontaminate
from epiledger.llm.hmm import score_texts
from epiledger.llm.langid import identify, learn
from epiledger.llm.lines import remove_boilerplate
from epiledger.llm.packing import pack
from epiledger.llm.prefix_trie import conversation_trie
from epiledger.llm.quality import judge
from epiledger.llm.ranked_search import rank_documents
from epiledger.llm.secret_scan import ALLOWED, ENTROPY, SCALE, SHAPES, listed, scan_secrets
from epiledger.llm.sharding import shard_by_size
from epiledger.llm.simhash import near_duplicates
from epiledger.llm.urlrules import judge_urls
from epiledger.llm.warc import captures, read_records, write_archives
from epiledger.sources.shared import as_table, shared_folder

SHARDS = 24
FAMILY, BORROWED = 5, 9
MIN_SITES = 10
COVERAGE = 0.6
TOKENIZER = "word_bpe_49k.json"
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all documents, sizes near equal; see :func:`shard_by_size` for nulls, equal and repeated rows."""
    return shard_by_size(read(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; see :func:`score_texts` for nulls, repeated rows and nothing to learn from."""
    return score_texts(read(spark, sf_dir, "documents"), in_fold("doc_id", 7)).withColumnRenamed("id", "doc_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of all documents; see :func:`judge` for nulls and repeated rows."""
    return judge(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; see :func:`identify` for nulls and :func:`learn` for what is learned from."""
    docs = read(spark, sf_dir, "documents")
    languages = learn(docs, ~in_fold("doc_id", 4))
    return identify(docs.select("doc_id", "text"), languages).select(
        "doc_id", in_fold("doc_id", 4).alias("held_out"), "lang_pred", "score"
    )


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page; see :func:`judge_urls` for nulls and urls without a host."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(read(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences; see :func:`pack` for nulls and long texts."""
    packed = pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packed.select(
        F.col("id").alias("doc_id"), F.col("piece").cast("int").alias("piece"), "start", "length",
        "ids_crc32", "sequence_id", "offset",
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark item that each document leaks, if any; see :func:`decontaminate` for nulls and short items."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, read(spark, sf_dir, "benchmark"), COVERAGE)
    return found.select("doc_id", "contaminated", "item_id", "coverage")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that many sites share; see :func:`remove_boilerplate` for nulls and ties."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return remove_boilerplate(docs, MIN_SITES).select("doc_id", "text", "n_lines", "n_removed")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of all pages as read back from archives; see :func:`write_archives` for nulls, ties and repeated ids."""
    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(read(spark, sf_dir, "pages"), folder)
    found = captures(as_table(read_records(spark, folder, payloads=False), "warc-records"))
    page_id = lambda c: F.regexp_extract(F.col(c), "page-id: (-?[0-9]+)", 1).try_cast("bigint")
    return found.select(
        page_id("metadata.fields").alias("page_id"),
        F.coalesce("capture.payload_bytes", "original.payload_bytes").alias("payload_bytes"),
        F.col("capture.payload_digest").alias("payload_digest"),
        F.col("capture.record_type").alias("record_type"),
        page_id("original.metadata.fields").alias("refers_to"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents; see :func:`near_duplicates` for nulls and repeated rows."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item; see :func:`rank_documents` for nulls, ties and repeated rows."""
    found = rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of conversations rebuilt on their family's first one; see :func:`conversation_trie` for nulls and ties."""
    c = F.col("conv_id")
    return conversation_trie(
        read(spark, sf_dir, "conversations"),
        base=c - c % FAMILY,
        borrowed=F.crc32(c.cast("string")) % BORROWED,
        most_borrowed=BORROWED - 1,
    )


def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document; see :func:`scan_secrets` for nulls, empty and long texts and ties."""
    found = scan_secrets(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in SHAPES],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_lm_scoring, op3_quality_rules, op4_language_id, op5_url_filters, op6_packing,
        op7_decontamination, op8_line_dedup, op9_warc, op10_simhash,
        op11_ranked_search, op12_prefix_trie, op13_secret_scans,
    )
}

_URL_VALUES = ", ".join(str(r) for r in URL_RULES)



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets_twin(width: int = 20) -> str:
    """All windows of all candidates by counting anew, where the operator moves the counts along."""
    kinds = {k: (p, g, n) for k, (p, g, n) in SHAPES.items()}
    kinds |= {k: (e[2] % width, 0, width) for k, e in ENTROPY.items()}
    lists = " UNION ALL ".join(
        f"SELECT r, {_quoted(kind)} AS kind, {rank} AS rank, {least} AS least,"
        f" regexp_extract_all(text, {_quoted(p)}) AS found, regexp_extract_all(text, {_quoted(p)}, {g}) AS sized,"
        f" regexp_split_to_array(text, {_quoted(p)}) AS pieces FROM docs"
        for rank, (kind, (p, g, least)) in enumerate(kinds.items())
    )
    needs = " OR ".join(
        f"kind = {_quoted(k)} AND " + " AND ".join(f"regexp_matches(match, {_quoted(p)})" for p in e[3])
        for k, e in ENTROPY.items()
    )
    # RE2 has no references to groups: a match of repeated groups is one that moves onto itself.
    allow = " OR ".join(
        f"regexp_matches(match, {_quoted(p)})" if "\\1" not in p else
        "(" + " OR ".join(f"match = substr(repeat(left(match, {k}), CAST(length(match) / {k} + 1 AS INT)), 1, length(match))"
                          f" AND length(match) % {k} = 0 AND length(match) > {k}" for k in range(1, 9)) + ")"
        for p in ALLOWED
    )
    bits = " ".join(f"WHEN {_quoted(k)} THEN {e[4]}" for k, e in ENTROPY.items())
    plain = ", ".join(_quoted(k) for k, e in ENTROPY.items() if not e[1])
    counts = ", ".join(
        f"count(*) FILTER (WHERE kind = {_quoted(k)})::BIGINT AS n_{k}" for k in SHAPES
    )
    shapes = ", ".join(_quoted(k) for k in SHAPES)
    item = "kind || ':' || s || ':' || e"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        lists AS ({lists}),
        places AS (SELECT *, unnest(range(1, len(found) + 1)) AS j FROM lists),
        matches AS (
            SELECT r, kind, rank, found[j] AS match,
                   (list_sum([length(x) FOR x IN pieces[1:j]]) + coalesce(list_sum([length(x) FOR x IN found[1:j - 1]]), 0))::INT AS s
            FROM places WHERE length(sized[j]) >= least),
        likely AS (
            SELECT row_number() OVER () AS c, r, kind, rank, s, CASE WHEN kind IN ({plain}) THEN lower(match) ELSE match END AS match
            FROM matches WHERE ({needs}) AND NOT ({allow})),
        windows AS (
            SELECT *, unnest(range(0, length(match) - {width} + 1)) AS w FROM likely),
        letters AS (
            SELECT c, w, substr(match, w + k + 1, 1) AS letter, count(*) AS n
            FROM windows, range({width}) AS step(k) GROUP BY ALL),
        sums AS (SELECT c, w, sum(round({SCALE} * n * log2(n))) AS total FROM letters GROUP BY ALL),
        high AS (
            SELECT r, kind, rank, s + min(w) AS s, s + max(w) + {width} AS e
            FROM sums JOIN likely USING (c)
            WHERE total <= floor({SCALE} * {width} * (log2({width}) - CASE kind {bits} END))
            GROUP BY c, r, kind, rank, s),
        spans AS (
            SELECT r, kind, rank, s, s + length(match) AS e FROM matches WHERE kind IN ({shapes})
            UNION ALL SELECT * FROM high),
        joined AS (
            SELECT r, {counts},
                   string_agg({item}, ',' ORDER BY s, rank, e) FILTER (WHERE kind IN ({shapes})) AS base,
                   string_agg({item}, ',' ORDER BY s, rank, e) AS spans
            FROM spans GROUP BY r)
        SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in SHAPES)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN joined ON docs.r = joined.r
    """


ORACLES = {
    "op11_ranked_search": r"""
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        whole AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM split),
        sized AS (
            SELECT r, doc_id, 25 + (75 * len(terms) * n_docs) // n_terms AS m FROM split, whole WHERE len(terms) > 0),
        tfs AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM split) GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tfs, whole GROUP BY term),
        items AS (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        asked AS (
            SELECT q, term, count(*) AS times FROM (
                SELECT q, unnest(regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items)
            GROUP BY ALL),
        scored AS (
            SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sized USING (r) GROUP BY ALL),
        ranked AS (
            SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
            FROM scored JOIN sized USING (r) WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (q) WHERE rank <= 10
    """,
    "op12_prefix_trie": f"""
        WITH own AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i
            FROM conversations WHERE conv_id IS NOT NULL),
        crc AS (
            SELECT conv_id, count(*) AS n,
                   xor(list_reduce(
                       list_prepend(4294967295, flatten([list_concat([ascii(d)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])
                                                         FOR d IN string_split(conv_id::VARCHAR, '')])),
                       lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END),
                   4294967295) % {BORROWED} AS h
            FROM own GROUP BY conv_id),
        rebuilt AS (
            SELECT c.conv_id, b.i + 1 AS depth, b.role, b.text
            FROM crc c JOIN own b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY} AND b.i < c.h
            UNION ALL
            SELECT o.conv_id, o.i - c.h + 1 + least(c.h, coalesce(b.n, 0)), o.role, o.text
            FROM own o JOIN crc c ON o.conv_id = c.conv_id AND o.i >= c.h
            LEFT JOIN crc b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY}),
        whole AS (
            SELECT crc.conv_id,
                   coalesce(list(md5(role) || md5(text) ORDER BY depth) FILTER (WHERE depth IS NOT NULL), []) AS path,
                   coalesce(list(strlen(text) ORDER BY depth) FILTER (WHERE depth IS NOT NULL), []) AS sizes
            FROM crc LEFT JOIN rebuilt ON crc.conv_id = rebuilt.conv_id GROUP BY crc.conv_id),
        member AS (SELECT *, unnest(range(0, len(path) + 1)) AS depth FROM whole),
        nodes AS (
            SELECT path[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(min(sizes[depth]), 0) AS size,
                   string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth) AS ends
            FROM member GROUP BY ALL),
        above AS (
            SELECT path[1:k] AS top, k, depth, conv_id, n_convs, size, path
            FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM nodes)),
        childless AS (SELECT path FROM above GROUP BY path HAVING path NOT IN (SELECT top FROM above WHERE k < depth)),
        sums AS (
            SELECT top, count(*) FILTER (WHERE depth = k + 1) AS n_children,
                   count(*) FILTER (WHERE path IN (SELECT path FROM childless)) AS n_leaves,
                   sum((n_convs - 1) * size)::BIGINT AS saved_tokens
            FROM above GROUP BY top)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens,
               sha256(coalesce(n.ends, '')) AS ends_sha256
        FROM nodes n JOIN sums ON n.path = sums.top
        LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1] AND p.depth = n.depth - 1
    """,
    "op13_secret_scans": _secrets_twin(),
    "op3_quality_rules": r"""
        WITH split AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words,
                   [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
            FROM documents),
        windows AS (
            SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
        twice AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
        covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS step(k) GROUP BY doc_id),
        measured AS (
            SELECT split.doc_id, text, len(words)::BIGINT AS n_words,
                   length(array_to_string(words, ''))::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                   coalesce(n, 0)::BIGINT AS n_repeat_words
            FROM split LEFT JOIN covered ON split.doc_id = covered.doc_id),
        based AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed
                    OR n_symbols * 10 > n_words
                    OR word_chars < 2 * n_words OR word_chars > 12 * n_words
                    OR n_dup_lines > 3 AND n_dup_lines * 10 > 3 * (1 + length(text) - length(replace(text, chr(10), '')))
                    OR (length(text) - length(replace(text, '!!', ''))) / 2 * 10 > n_words
                    OR length(regexp_replace(text, '[^A-Z]', '', 'g')) * 2 > word_chars) AS kept
        FROM based
    """,
    "op5_url_filters": rf"""
        WITH parsed AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages),
        rules(rule_host, rule_path, verdict) AS (VALUES {_URL_VALUES}),
        fitting AS (
            SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM parsed JOIN rules
              ON (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path)
            GROUP BY page_id)
        SELECT parsed.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parsed LEFT JOIN fitting ON parsed.page_id = fitting.page_id
    """,
    "op8_line_dedup": rf"""
        WITH split AS (
            SELECT doc_id, coalesce(source, '') AS site, text, string_split(text, chr(10)) AS lines FROM documents),
        placed AS (
            SELECT doc_id, site, unnest(range(0, len(lines))) AS place,
                   unnest([trim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) FOR l IN lines]) AS line
            FROM split),
        solid AS (SELECT * FROM placed WHERE line <> ''),
        shared AS (SELECT line FROM solid GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
        gone AS (
            SELECT doc_id, place FROM (
                SELECT doc_id, place, row_number() OVER (PARTITION BY line ORDER BY doc_id, place) AS nth
                FROM solid WHERE line IN (SELECT line FROM shared)) WHERE nth > 1),
        removed AS (SELECT doc_id, list(place) AS places, count(*)::INT AS n FROM gone GROUP BY doc_id),
        solid_lines AS (SELECT doc_id, count(*)::INT AS n FROM solid GROUP BY doc_id)
        SELECT split.doc_id,
               CASE WHEN removed.n IS NULL THEN text
                    ELSE array_to_string([lines[i + 1] FOR i IN range(0, len(lines)) IF NOT list_contains(places, i)], chr(10))
               END AS text,
               coalesce(solid_lines.n, 0) AS n_lines, coalesce(removed.n, 0) AS n_removed
        FROM split LEFT JOIN removed ON split.doc_id = removed.doc_id
        LEFT JOIN solid_lines ON split.doc_id = solid_lines.doc_id
    """,
}
