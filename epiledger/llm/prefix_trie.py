"""Prefix trie of conversations: which beginnings they share, and what sharing them would save."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epiledger.sources.shared import as_table

PARTS = ("p1", "p2", "p3", "p4")
END_IDS = 4096  # ids in one piece of an end list


def turn_table(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, digest, bytes, row): turns without their texts, ``row`` rising in order of id and turn.

    Digests stand for texts from here on, so a text is read once and never shuffled.  The table is dealt
    by ranges of all its columns, so one conversation of any length lies in many partitions.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_))).alias("digest"),
        F.octet_length(text_).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("read"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest", "read"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return as_table(
        ordered.select("conv_id", "digest", "bytes", F.monotonically_increasing_id().alias("row")), "trie-rows"
    )


def _before(column: str) -> Column:
    window = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def rebuild(
    rows: DataFrame, base: Column, borrowed: Column, most_borrowed: int, block_bits: int = 16
) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one: (turns, conversations).

    The first ``borrowed`` turns of conversation ``base`` (both columns over ``conv_id``; at most
    ``most_borrowed``) come first, then the conversation's own turns after as many.  A turn is (conv_id,
    block, depth from 1, digest, bytes).  A turn's place is its row less its block's first row plus the turns
    of the blocks before: a block is at most 2 ** ``block_bits`` rows, and all joins with turns are on
    conversation and block, so no conversation is one task.
    """
    rows = rows.withColumn("block", F.call_function("shiftright", "row", F.lit(block_bits)))
    blocks = rows.groupBy("conv_id", "block").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    blocks = as_table(blocks.withColumn("before", _before("n")), "trie-blocks")
    lengths = blocks.groupBy("conv_id").agg(F.sum("n").alias("own"))
    known = lengths.select("conv_id", "own", base.alias("base"), borrowed.cast("long").alias("borrowed"))
    known = known.join(lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("offered")), "base", "left")
    known = as_table(
        known.select(
            "conv_id", "base", "borrowed",
            F.least("borrowed", F.coalesce("offered", F.lit(0))).alias("given"),
        ),
        "trie-conversations",
    )
    placed = rows.join(blocks.join(known, "conv_id"), ["conv_id", "block"]).withColumn(
        "place", F.col("before") + F.col("row") - F.col("first")
    )
    own = placed.where("place >= borrowed").select(
        "conv_id", "block", (F.col("given") + F.col("place") - F.col("borrowed") + 1).alias("depth"), "digest", "bytes"
    )
    heads = placed.where(F.col("place") < most_borrowed).select(
        F.col("conv_id").alias("base"), "place", "digest", "bytes"
    )
    lent = known.join(heads, "base").where("place < borrowed").select(
        "conv_id", F.lit(-1).cast("long").alias("block"), (F.col("place") + 1).alias("depth"), "digest", "bytes"
    )
    return own.unionByName(lent), known.select("conv_id")


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", depth.cast("string"), *[s.cast("string") for s in sums])))


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces as they come by, comma-joined; one piece at a time is in memory."""
    key, hashed = None, None
    for batch in batches:
        keys, hashes = [], []
        for k, piece in zip(batch.column(0), batch.column(1), strict=True):
            k, piece = k.as_py(), piece.as_py().encode()
            if k == key:
                hashed.update(b"," + piece)
            else:
                if key is not None:
                    keys.append(key)
                    hashes.append(hashed.hexdigest())
                key, hashed = k, hashlib.sha256(piece)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes, pa.string())], ["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([key], pa.binary()), pa.array([hashed.hexdigest()], pa.string())], ["key", "ends"]
        )


def end_lists(finals: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ascending ids of the conversations that end in each node.

    Ids are dealt by ranges and joined to pieces of up to 4,096 before the shuffle, so a node where
    very many end sends few rows; hashing goes through its pieces in order.
    """
    placed = as_table(
        finals.select("conv_id", "key").repartitionByRange("conv_id").sortWithinPartitions("conv_id")
        .withColumn("row", F.monotonically_increasing_id()),
        "trie-ends",
    )
    pieces = placed.groupBy("key", F.floor(F.col("row") / END_IDS).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    ordered = pieces.repartition("key").sortWithinPartitions("key", "piece")
    return ordered.select("key", "ids").mapInArrow(_end_hashes, "key binary, ends string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns, from the root without turns down.

    ``turns`` are (conv_id, block, depth, digest, bytes) as :func:`rebuild` gives them, blocks of a
    conversation in order of depth; ``conversations`` are all ids, one row each, with or without turns.
    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    1. A sequence's key is a sum over its turns of 128 hash bits of depth and digest, so the key of
       any prefix is a running total, and a long conversation's is added up block by block.
    2. Identical conversations collapse into one weighted sequence, for which the smallest id stands.
       Only its turns are followed further.
    3. Sequences that are no proper prefix of another, by anti-join, are the leaves.
    4. Weighted prefixes are aggregated by key where they lie, then merged.

    What a subtree saves needs no walk.  With B a sequence's bytes, b those before the node, w its
    weight, and s the bytes before the first node of which it is the smallest member, each sequence
    through the node adds w (B - b), and its first copies of turns cost B - max(b, s).

    Without conversations there is no node, not even a root.
    """
    half = lambda h, k: F.call_function("shiftrightunsigned", h, F.lit(32)) if k else h.bitwiseAND(F.lit(0xFFFFFFFF))
    hashes = [F.xxhash64(F.lit(salt), F.col("depth"), F.col("digest")) for salt in (1, 2)]
    pieces = [half(hashes[k // 2], k % 2).alias(p) for k, p in enumerate(PARTS)]
    turns = as_table(turns.select("conv_id", "block", "depth", "bytes", *pieces), "trie-turns")

    totals = turns.groupBy("conv_id", "block").agg(
        *[F.sum(c).alias(c) for c in (*PARTS, "bytes")], F.count(F.lit(1)).alias("n")
    )
    totals = as_table(totals.select("*", *[_before(c).alias(f"{c}_before") for c in (*PARTS, "bytes")]), "trie-totals")
    whole = totals.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in (*PARTS, "bytes", "n")])
    whole = conversations.join(whole, "conv_id", "left").na.fill(0, [*PARTS, "bytes", "n"])
    finals = as_table(
        whole.select("conv_id", "n", "bytes", _key(F.col("n"), [F.col(p) for p in PARTS]).alias("key")), "trie-finals"
    )
    sequences = as_table(
        finals.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("weight"),
            F.min("bytes").alias("total"),
        ),
        "trie-sequences",
    )

    sums = [F.col(f"{p}_before") + F.sum(p).over(_upto()) for p in PARTS]
    followed = turns.join(
        totals.select("conv_id", "block", *[f"{c}_before" for c in (*PARTS, "bytes")]).join(
            sequences.select("conv_id"), "conv_id"
        ),
        ["conv_id", "block"],
    ).select(
        "conv_id", "block", "depth", "bytes", *PARTS,
        *[s.alias(f"{p}_sum") for p, s in zip(PARTS, sums, strict=True)],
        (F.col("bytes_before") + F.sum("bytes").over(_upto()) - F.col("bytes")).alias("skipped"),
    )
    prefixes = as_table(
        followed.select(
            "conv_id", "block", "depth", "skipped",
            _key(F.col("depth"), [F.col(f"{p}_sum") for p in PARTS]).alias("key"),
            _key(F.col("depth") - 1, [F.col(f"{p}_sum") - F.col(p) for p in PARTS]).alias("parent"),
        ),
        "trie-prefixes",
    )

    root = sequences.select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("skipped"),
        _key(F.lit(0), [F.lit(0)] * len(PARTS)).alias("key"),
        F.lit(None).cast("binary").alias("parent"),
    )
    all_prefixes = prefixes.drop("block").unionByName(root)
    owners = all_prefixes.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("skipped").alias("skipped")
    )
    first_owned = owners.groupBy("conv_id").agg(F.min_by("skipped", "depth").alias("since"))
    proper = prefixes.select(F.col("parent").alias("key")).distinct()
    leaves = sequences.join(proper, "key", "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    facts = as_table(
        sequences.join(first_owned, "conv_id", "left").join(leaves, "conv_id", "left").select(
            "conv_id", "weight", "total",
            F.coalesce("since", "total").alias("since"),
            F.coalesce("leaf", F.lit(0)).alias("leaf"),
        ),
        "trie-facts",
    )

    with_facts = (
        prefixes.join(totals.select("conv_id", "block").join(facts, "conv_id"), ["conv_id", "block"])
        .drop("block").unionByName(root.join(facts, "conv_id"))
    )
    saved = F.col("weight") * (F.col("total") - F.col("skipped")) - F.col("total") + F.greatest("skipped", "since")
    nodes = as_table(
        with_facts.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.min("parent").alias("parent"),
            F.sum("weight").alias("n_convs"),
            F.sum("leaf").alias("n_leaves"),
            F.sum(saved).alias("saved_tokens"),
        ),
        "trie-nodes",
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(parents, "parent", "left").join(children, "key", "left").join(end_lists(finals), "key", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves", "saved_tokens",
            F.coalesce("ends", F.lit(none)).alias("ends_sha256"),
        )
    )


def _upto():
    return Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)


def conversation_trie(
    conversations: DataFrame, base: Column, borrowed: Column, most_borrowed: int, block_bits: int = 16
) -> DataFrame:
    """The prefix trie of the rebuilt conversations; see :func:`rebuild` and :func:`prefix_trie`.

    Turns of a conversation are taken by ``turn``, null first; turns of equal number by the digest of role
    and text, so repeated rows are turns of their own in either order.  A null role or text is empty.  Rows
    with a null ``conv_id`` belong to no conversation and are left out.  Texts of any length are digested
    where they are read.  Of an empty table the result is empty.  Other columns are not read.
    """
    turns, ids = rebuild(turn_table(conversations), base, borrowed, most_borrowed, block_bits)
    return prefix_trie(turns, ids)
