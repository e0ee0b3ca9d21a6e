"""Near-duplicates by SimHash and multi-index hashing, alone and with an exact check.

:func:`near_duplicates` links 64-bit fingerprints a few bits apart.  Texts with a similarity of 0.8
are about ten bits apart there, too many for selective lookups; :func:`similar_texts` finds
those by MinHash beside the fingerprints and compares the shingles of all that meet.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiledger.llm.common import dealt, row_key, slices
from epiledger.llm.graph import components
from epiledger.sources.shared import as_table, scratch_tables

SEED = 42


def simhash(text: str | None, words: int = 3) -> int:
    """64 bits; a bit is 1 if it is set in over half the hashes of the word shingles.

    Shingles are counted as often as they occur.  Hashes are tallied in stretches, so a text of
    any length needs no more memory than its words.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    last = max(len(tokens) - words + 1, 1)
    digest = xxhash.xxh64_intdigest
    tally = np.zeros(64, np.int64)
    for start in range(0, last, 16384):
        part = tokens[start : start + 16384 + words - 1]
        n = min(16384, last - start)
        shingles = part if words == 1 else map(b" ".join, zip(*(part[k:] for k in range(words)), strict=False))
        if len(tokens) < words:
            shingles = [b" ".join(tokens)]
        hashes = np.fromiter((digest(s, SEED) for s in shingles), ">u8", n)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1)
        tally += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * tally > last).tobytes(), "big")


def with_fingerprints(
    docs: DataFrame, words: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id, a row key and the fingerprint of each document, as a signed long."""
    source = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"),
        row_key(id_column, text_column).alias("row_key"),
    )

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (simhash(t, words) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows
            )
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(prints.view(np.int64))],
                ["id", "row_key", "fingerprint"],
            )

    schema = T.StructType([source.schema["id"], source.schema["row_key"], T.StructField("fingerprint", T.LongType())])
    return source.mapInArrow(tag, schema)


RUN_BITS = 4


def near_links(prints: DataFrame, distance: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (``a``, ``b``), a < b, of distinct fingerprints at most ``distance`` bits apart.

    The 64 bits are cut into segments.  Of two fingerprints that near, some segment differs in at
    most ``distance // segments`` bits, so each fingerprint looks up, for every segment, the
    small Hamming ball around its value; what it meets is compared in full.

    The values of a ball are not listed one by one, as every one would be a shuffled row.  A segment is cut
    into runs of four bits.  Two values n bits apart agree outside some n runs, so they meet in a table whose
    key leaves these out.  If n is odd, one value has an even and one an odd number of bits set, and only those
    meet: a value that many fingerprints share meets itself in the table of whole values alone.  A ball of
    radius 1 around 32 bits takes ten rows instead of 34, and evenly spread fingerprints are compared as often:
    with two segments they fill the tables thinly up to a few billion.
    The rows are never sent whole, however small the table they are made from.  The join sorts them by the
    segment first, as nearly all values differ there.
    """
    width = 64 // segments
    if width > 62:
        raise ValueError("segments have fewer bits")
    mask = (1 << width) - 1
    runs = [mask & (((1 << RUN_BITS) - 1) << low) for low in range(0, width, RUN_BITS)]
    tables, crossed = [], []
    for s in range(segments):
        value = F.shiftrightunsigned("fingerprint", s * width).bitwiseAND(F.lit(mask))
        for n in range(distance // segments + 1):
            odd = F.bit_count(value) % 2 == 1 if n % 2 else F.lit(None).cast("boolean")
            for left_out in itertools.combinations(runs, min(n, len(runs))):
                key = value.bitwiseAND(F.lit(mask - sum(left_out)))
                crossed += [len(tables)] * (n % 2)
                tables.append(F.struct(F.lit(len(tables)).alias("table"), key.alias("segment"), odd.alias("odd")))
    rows = prints.select(F.explode(F.array(*tables)).alias("k"), "fingerprint").select("k.*", "fingerprint")
    one = rows.where("odd IS NULL OR NOT odd").select("segment", "table", F.col("fingerprint").alias("a"))
    two = rows.where("odd IS NULL OR odd").select("segment", "table", F.col("fingerprint").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    met = (apart <= distance) & ((F.col("a") < F.col("b")) | F.col("table").isin(crossed))
    return (
        dealt(one).join(two, ["segment", "table"]).where(met)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    distance: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``id``, ``row_key``, ``fingerprint``, ``label``, ``component_id``.

    Fingerprints at most ``distance`` bits apart are linked; documents whose fingerprints are
    connected by links form a component.  ``label`` is its smallest fingerprint and
    ``component_id`` its smallest id.  Copies share a fingerprint and never meet as pairs.

    A text without words, null or empty, has fingerprint 0 and is linked like any other.
    Rows with null ids are kept; a component of null ids alone has a null ``component_id``.
    Repeated rows get equal results.  Of an empty table the result is empty.  Other columns
    are not read.
    """
    tagged = as_table(with_fingerprints(docs, words, id_column, text_column), "simhash-prints")
    prints = as_table(
        tagged.groupBy("fingerprint").agg(F.min("id").alias("least")), "simhash-distinct"
    )
    links = as_table(near_links(prints.select("fingerprint"), distance), "simhash-links")
    labels = components(links)
    named = prints.join(labels, prints.fingerprint == labels.node, "left").select(
        "fingerprint", "least", F.coalesce("label", "fingerprint").alias("label")
    )
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = as_table(named.join(least, "label").select("fingerprint", "label", "component_id"), "simhash-classes")
    return dealt(tagged).join(named, "fingerprint")


def _spread(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """``lanes`` independent 64-bit values for each hash, by the splitmix64 sequence."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = hashes[:, None] + steps
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def text_codes(text: str | None, words: int = 5) -> np.ndarray:
    """Hashes of a text's distinct shingles, sorted.

    A text of fewer words is one shingle.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    known = {t: xxhash.xxh64_intdigest(t, SEED) for t in set(tokens)}
    codes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(codes))
    shingles = np.zeros(len(codes) - width + 1 if width else 0, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            shingles = shingles * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + len(shingles)]
    return np.unique(shingles)


BANDS, BAND_ROWS = 24, 6


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One key for each of ``BANDS`` bands of ``BAND_ROWS`` minima of the hashed shingles.

    Sets with Jaccard similarity j agree in a minimum with probability j, so in some band with
    ``1 - (1 - j ** BAND_ROWS) ** BANDS``: 0.9993 at 0.8, 0.99996 at 0.85.  Without shingles all are 0.
    """
    if not len(shingles):
        return np.zeros(BANDS, np.int64)
    factors = _spread(np.array([SEED], np.uint64), BANDS * BAND_ROWS)[0] | np.uint64(1)
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), 512):
            np.minimum(least, (shingles[start : start + 512, None] * factors).min(0), out=least)
        keys = np.arange(BANDS, dtype=np.uint64)
        for column in least.reshape(BANDS, BAND_ROWS).T:
            keys = _spread(keys ^ column, 1)[:, 0]
    return keys.view(np.int64)


def with_bands(
    docs: DataFrame, words: int = 5, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id, a row key, the fingerprint, the MD5 of the set of shingles and the band keys of each document."""
    source = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"),
        row_key(id_column, text_column).alias("row_key"),
    )

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                prints, keys, bands = np.zeros(batch.num_rows, np.uint64), [], []
                for k, scalar in enumerate(batch.column(1)):
                    text = scalar.as_py()
                    prints[k] = simhash(text)
                    shingles = text_codes(text, words)
                    keys.append(hashlib.md5(shingles.tobytes()).digest())
                    bands.append(band_keys(shingles))
                columns = [pa.array(prints.view(np.int64)), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.record_batch(
                    [batch.column(0), batch.column(2), *columns], ["id", "row_key", "fingerprint", "print_key", "bands"]
                )

    return source.mapInArrow(
        tag,
        T.StructType(
            [
                source.schema["id"], source.schema["row_key"], T.StructField("fingerprint", T.LongType()),
                T.StructField("print_key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
            ]
        ),
    )


def with_company(nodes: DataFrame) -> DataFrame:
    """The ``node`` of those that share a band key with any other, found without building the pairs.

    Keys are reduced to their least and greatest node map-side and only those with two are kept, in a
    table.  Spark sends it to the nodes where its size allows, so that their keys are not dealt again.
    """
    own = nodes.select(F.explode("bands").alias("key"), "node")
    shared = own.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    shared = as_table(shared.select("key"), "similar-keys")
    return own.join(shared, "key", "left_semi").select("node").distinct()


def with_linked_fingerprints(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """The ``node`` of those whose ``fingerprint`` another node has too or is an end of a link."""
    ends = links.select(F.explode(F.array("a", "b")).alias("fingerprint"))
    several = nodes.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fingerprint")
    return nodes.join(ends.unionByName(several).distinct(), "fingerprint", "left_semi").select("node")


def shingle_sets(texts: DataFrame, words: int = 5) -> DataFrame:
    """The ``node``, the hashes of its ``text``'s shingles ``codes`` and their number ``n_shingles``."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                found = [text_codes(t.as_py(), words).view(np.int64) for t in batch.column(1)]
                columns = [batch.column(0), pa.array(found, pa.list_(pa.int64())), pa.array([len(f) for f in found], pa.int64())]
                yield pa.record_batch(columns, ["node", "codes", "n_shingles"])

    return texts.select("node", "text").mapInArrow(codes, "node long, codes array<long>, n_shingles long")


def shared_shingles(sets: DataFrame) -> DataFrame:
    """Of each ``node`` of a stored table of sets ``n_shingles``, and ``n_shared`` that other nodes have too.

    Equal hashes of different shingles can only raise ``n_shared``.
    """
    own = as_table(
        sets.select("node", F.explode("codes").alias("code"))
        .groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
        .where("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("n_own")),
        "similar-own",
    )
    return sets.select("node", "n_shingles").join(dealt(own), "node", "left").select(
        "node", "n_shingles", (F.col("n_shingles") - F.coalesce("n_own", F.lit(0))).alias("n_shared")
    )


def _may_link(a: str, b: str, similarity: float) -> Column:
    """False where the counts rule out the similarity: at most the lesser ``n_shared`` is common to both."""
    common = F.least(f"{a}.n_shared", f"{b}.n_shared")
    both = F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles")
    return common * (1 + similarity) >= both * similarity - 1e-6


def met_by_fingerprint(nodes: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """Pairs (``a``, ``b``), a < b, of each node with one of its own fingerprint and one of the least linked to it.

    Pairs whose counts rule out the similarity are left out.
    """
    own = nodes.select("fingerprint", F.struct("node", "n_shingles", "n_shared").alias("b"))
    heads = own.groupBy("fingerprint").agg(F.min("b").alias("a"))
    least = links.groupBy(F.col("b").alias("fingerprint")).agg(F.min("a").alias("least"))
    linked = own.join(least, "fingerprint").join(heads.withColumnRenamed("fingerprint", "least"), "least")
    ends = own.join(heads, "fingerprint").select("a", "b").unionByName(linked.select("a", "b"))
    return _pairs(ends.where("a.node <> b.node").where(_may_link("a", "b", similarity)))


def linked_across(nodes: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """Pairs (``a``, ``b``), a < b, of nodes of different ``label`` whose fingerprints are equal or linked.

    Pairs whose counts rule out the similarity are left out.  Fingerprints whose nodes are all of one label do
    not meet.
    """
    labels = nodes.groupBy("fingerprint").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    labels = as_table(labels, "similar-labels")
    one = labels.select(F.col("fingerprint").alias("a"), F.struct("low", "high").alias("one"))
    two = labels.select(F.col("fingerprint").alias("b"), F.struct("low", "high").alias("two"))
    mixed = links.join(one, "a").join(two, "b").where("one <> two OR one.low <> one.high").select("a", "b")
    equal = labels.where("low <> high").select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b"))
    meet = mixed.unionByName(equal).withColumnsRenamed({"a": "print_a", "b": "print_b"})
    own = F.struct("node", "label", "n_shingles", "n_shared")
    ends = (
        meet.join(nodes.select(F.col("fingerprint").alias("print_a"), own.alias("a")), "print_a")
        .join(nodes.select(F.col("fingerprint").alias("print_b"), own.alias("b")), "print_b")
    )
    return _pairs(ends.where("a.label <> b.label").where(_may_link("a", "b", similarity)))


def _pairs(ends: DataFrame) -> DataFrame:
    return ends.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def met_at_pivots(nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (``a``, ``b``), a < b, of each node with two others that share a band key.

    One is the node with the greatest share of shingles that others have too: of edited copies
    the least edited, which is nearest to most.  The other is the node with the greatest number.
    Pairs whose counts rule out the similarity are left out.
    """
    own = nodes.select(F.explode("bands").alias("key"), F.struct("node", "n_shingles", "n_shared").alias("own"))
    edited = 1 - F.col("own.n_shared") / F.col("own.n_shingles")
    pivots = own.groupBy("key").agg(
        F.min(F.struct(edited.alias("edited"), F.col("own.node").alias("node"), F.col("own").alias("own"))).alias("hub"),
        F.max("own").alias("last"),
    )
    ends = dealt(own).join(pivots, "key").select(
        F.explode(F.array("hub.own", "last")).alias("a"), F.col("own").alias("b")
    )
    return _pairs(ends.where("a.node <> b.node").where(_may_link("a", "b", similarity)))


def met_in_bands(nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (``a``, ``b``), a < b, of nodes of different ``label`` that share a band key.

    Nodes of one label are connected already and do not meet, nor do those whose counts rule out
    the similarity.  Of the keys that two share, they meet in the first.
    """
    own = nodes.select(
        F.posexplode("bands").alias("band", "key"), F.struct("node", "label", "n_shingles", "n_shared", "bands").alias("own")
    )
    labels = nodes.select(F.explode("bands").alias("key"), "label").groupBy("key")
    mixed = labels.agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    own = own.join(as_table(mixed.select("key"), "similar-mixed"), "key", "left_semi")
    agree = F.zip_with("a.bands", "b.bands", lambda x, y: x == y)
    met = dealt(own.select("key", "band", F.col("own").alias("a"))).join(
        own.select(F.col("key").alias("key_b"), F.col("own").alias("b")),
        (F.col("key") == F.col("key_b")) & (F.col("a.node") < F.col("b.node"))
        & (F.col("a.label") != F.col("b.label")) & _may_link("a", "b", similarity)
        & (F.array_position(agree, True) == F.col("band") + 1),
    )
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def similar_texts(
    docs: DataFrame,
    words: int = 5,
    similarity: float = 0.8,
    distance: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``id``, ``row_key``, ``label``, ``component_id``.

    Links texts whose sets of word shingles have that Jaccard similarity or more.  Candidates are, as in
    :func:`near_duplicates`, texts with fingerprints at most ``distance`` bits apart, found by multi-index
    hashing; and, as a similarity of 0.8 is about ten bits, those that share one of the :func:`band_keys`,
    which miss 7 pairs in 10,000 at 0.8 and fewer above, however the texts differ: edited, cut or extended.
    Every candidate is then compared by the shingles themselves, as 64-bit hashes.  Documents connected
    by links form a component; ``component_id`` is its smallest id.

    A large group of near copies would meet in as many pairs as its square.  Three steps lessen
    that, none of which loses a pair of the similarity.  Nodes that meet another are found without
    building pairs, and for these is counted how many of their shingles any other such node has; too
    few rule out every partner.  The rest are compared with two pivots of each band key, one node of their
    fingerprint and one of the least linked to it.  At last they meet only across the components
    this gives, and only where the shared shingles of both allow the similarity.  All
    tables but the two that the result reads are deleted once it is known.

    Texts with equal sets of shingles, copies above all, are one node and never meet as pairs.  Null
    and empty texts have no words and form one component.  Rows with null ids are kept; a
    component of null ids alone has a null ``component_id``.  Repeated rows get equal results.
    Of an empty table the result is empty.  Other columns are not read.
    """
    tagged = as_table(with_bands(docs, words, id_column, text_column), "similar-prints")
    texts = docs.select(row_key(id_column, text_column).alias("row_key"), F.col(text_column).alias("text"))
    with scratch_tables(docs.sparkSession):
        named = _classes(tagged, texts, words, similarity, distance)
    return dealt(tagged.select("id", "row_key", "print_key")).join(named, "print_key").select("id", "row_key", "label", "component_id")


def _classes(tagged: DataFrame, texts: DataFrame, words: int, similarity: float, distance: int) -> DataFrame:
    """A stored table of ``print_key``, ``label`` and ``component_id``."""
    nodes = as_table(
        tagged.groupBy("print_key").agg(
            F.min("id").alias("least"), F.min("row_key").alias("row_key"), F.min("fingerprint").alias("fingerprint"),
            F.any_value("bands").alias("bands"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "similar-nodes",
    )
    prints = as_table(nodes.select("fingerprint").distinct(), "similar-fingerprints")
    near = as_table(near_links(prints, distance), "similar-near")
    met = with_company(nodes.select("node", "bands")).unionByName(
        with_linked_fingerprints(nodes.select("node", "fingerprint"), near)
    )
    company = as_table(
        nodes.select("node", "row_key", "fingerprint", "bands").join(met.distinct(), "node"), "similar-company"
    )
    wanted = texts.join(company.select("row_key", "node"), "row_key").dropDuplicates(["node"])
    sets = as_table(shingle_sets(wanted, words), "similar-shingles")
    able = shared_shingles(sets).where(
        (F.col("n_shingles") > 0) & (F.col("n_shared") >= similarity * F.col("n_shingles") - 1e-6)
    )
    keyed = as_table(able.join(dealt(company.select("node", "fingerprint", "bands")), "node"), "similar-able")

    def verified(met: DataFrame, name: str) -> DataFrame:
        """Those that are as similar as asked.  Of each pair the two sets travel once, and meet by the pair."""
        pairs = as_table(met, f"{name}-met")
        ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node"))
        both = dealt(ends).join(sets.select("node", "codes"), "node").groupBy("a", "b").agg(F.collect_list("codes").alias("sets"))
        one, two = F.col("sets")[0], F.col("sets")[1]
        common = F.size(F.array_intersect(one, two))
        alike = common * (1 + similarity) >= (F.size(one) + F.size(two)) * similarity - 1e-6
        return as_table(both.where(alike).select("a", "b"), name)

    def labelled(some: DataFrame, links: DataFrame) -> DataFrame:
        labels = components(links).withColumnRenamed("node", "linked")
        return some.join(labels, some.node == labels.linked, "left").select(
            *some.columns, F.coalesce("label", "node").alias("label")
        )

    met = met_by_fingerprint(keyed, near, similarity).unionByName(met_at_pivots(keyed, similarity))
    stars = verified(met.distinct(), "similar-stars")
    partly = as_table(labelled(keyed, stars), "similar-partly")
    met = linked_across(partly, near, similarity).unionByName(met_in_bands(partly, similarity))
    links = verified(met.distinct(), "similar-links")
    named = labelled(nodes.select("node", "print_key", "least"), stars.unionByName(links))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return as_table(named.join(least, "label").select("print_key", "label", "component_id"), "similar-classes", kept=True)
