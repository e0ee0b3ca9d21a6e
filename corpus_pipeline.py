"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiledger.llm.common import fresh, in_fold, read, row_key
from epiledger.llm.decontam import decontaminate
from epiledger.llm.langid import UNKNOWN, identify, learn, lettered
from epiledger.llm.lines import remove_boilerplate
from epiledger.llm.packing import pack
from epiledger.llm.queries import COVERAGE, MIN_SITES, TOKENIZER
from epiledger.llm.simhash import similar_texts
from epiledger.sources.shared import shared_folder


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language is found: null, empty or without a letter.

    A table from which no language can be learned, as no usable row has a label, loses the same
    documents and keeps all that have a letter.
    """
    languages = learn(docs, ~in_fold("doc_id", 4))
    if not languages.names:
        return lettered(docs)
    name, score = fresh("lang_pred", docs.columns), fresh("lang_score", docs.columns)
    found = identify(docs, languages, lang_name=name, score_name=score)
    return found.where(F.col(name) != UNKNOWN).select(docs.columns)


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that many sites share; drops documents of which nothing is left."""
    lines, removed = fresh("n_lines", docs.columns), fresh("n_removed", docs.columns)
    found = remove_boilerplate(docs, MIN_SITES, n_lines=lines, n_removed=removed)
    return found.where((F.col(removed) == 0) | (F.col(lines) > F.col(removed))).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id.

    Near copies share 0.8 or more of their five-word shingles.  Of rows that agree in id and
    text, one stays; null ids come last.
    """
    found = similar_texts(docs, words=5, similarity=0.8)
    kept = found.groupBy("label").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row_key")).alias("kept")
    )
    key = fresh("row_key", docs.columns)
    keys = kept.select(F.col("kept.row_key").alias(key))
    keyed = docs.withColumn(key, row_key("doc_id", "text"))
    return keyed.join(keys, key, "left_semi").dropDuplicates([key]).select(docs.columns)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    names = tuple(fresh(n, docs.columns) for n in ("contaminated", "item_id", "coverage"))
    found = decontaminate(docs, read(spark, sf_dir, "benchmark"), COVERAGE, names=names)
    return found.where(~F.col(names[0])).select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences, one row per piece of a document."""
    return pack(docs, public_tokenizers.path(TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", language),
    ("boilerplate", boilerplate),
    ("near_copies", near_copies),
    ("benchmarks", benchmarks),
    ("sequences", sequences),
]

# No SQL: language models, SimHash and the tokenizer have no expression in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is stored and read by the next."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
