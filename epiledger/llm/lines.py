"""Removal of lines that many sites share."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiledger.llm.common import fresh, row_key
from epiledger.sources.shared import as_table

BLANK = " \t\x0b\x0c\r"


def line_table(docs: DataFrame, id_column: str, text_column: str, site_column: str) -> DataFrame:
    """Every line that is not blank: row key, id, place, site, hash of the trimmed line."""
    split = docs.select(
        row_key(id_column, text_column).alias("row_key"),
        F.col(id_column).alias("id"),
        F.coalesce(F.col(site_column).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(F.col(text_column), "\n")).alias("place", "line"),
    )
    trimmed = split.withColumn("line", F.trim("line", F.lit(BLANK))).where("line <> ''")
    return trimmed.select("row_key", "id", "site", "place", F.unhex(F.md5("line")).alias("hash"))


def widespread(lines: DataFrame, min_sites: int, precision: int = 12) -> DataFrame:
    """Hashes of the lines found on at least ``min_sites`` sites.

    Only a line that occurs that often can be; for those, HyperLogLog sketches of their sites
    are built where the lines lie and merged.  An estimate within four standard errors of the
    threshold, or two sites, is not trusted: there sites are counted exactly.
    """
    often = lines.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites)
    sites = lines.select("hash", "site").join(often.select("hash"), "hash", "left_semi")
    spread = as_table(
        sites.groupBy("hash").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(precision))).alias("sites")
        ),
        "line-spread",
    )
    margin = max(2, math.ceil(min_sites * 4 * 1.04 / math.sqrt(1 << precision)))
    surely = spread.where(F.col("sites") > min_sites + margin).select("hash")
    near = spread.where(F.abs(F.col("sites") - min_sites) <= margin).select("hash")
    exact = (
        lines.select("hash", "site").join(near, "hash", "left_semi").distinct()
        .groupBy("hash").count().where(F.col("count") >= min_sites).select("hash")
    )
    return surely.unionByName(exact)


def remove_boilerplate(
    docs: DataFrame,
    min_sites: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    site_column: str = "source",
    n_lines: str = "n_lines",
    n_removed: str = "n_removed",
) -> DataFrame:
    """The documents without the lines that at least ``min_sites`` sites share.

    Lines are compared without white space at their ends; blank lines are neither counted nor
    removed.  The first occurrence of a line, by smallest id and then place in the text, stays
    where it is, so nothing vanishes from the corpus; all others go with their line break.
    Two more columns give the lines that are not blank and how many of them went; columns of
    those names are replaced.

    A null site is a site of its own, like the empty one.  Null ids come last.  Rows that
    agree in id and text are treated alike.  A null text stays null, with no lines; an empty
    one stays empty; a text may become empty.  Of an empty table the result is empty.
    """
    lines = as_table(line_table(docs, id_column, text_column, site_column), "lines")
    shared = as_table(widespread(lines, min_sites), "line-shared")
    found = as_table(lines.drop("site").join(shared, "hash"), "line-found")
    first = found.groupBy("hash").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row_key", "place")).alias("first")
    )
    gone = (
        found.join(first, "hash")
        .where((F.col("row_key") != F.col("first.row_key")) | (F.col("place") != F.col("first.place")))
        .groupBy("row_key")
        .agg(F.collect_set("place").alias("_gone"))
    )
    source = docs.drop(n_lines, n_removed)
    key, removed = fresh("_row_key", source.columns), fresh("_gone", source.columns)
    joined = source.withColumn(key, row_key(id_column, text_column)).join(
        gone.select(F.col("row_key").alias(key), F.col("_gone").alias(removed)), key, "left"
    )
    split = F.split(F.col(text_column), "\n")
    left = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(removed)))
    kept = F.array_join(F.transform(left, lambda k: F.get(split, k)), "\n")
    blank = F.lit(BLANK)
    return joined.select(
        *[
            F.when(F.col(removed).isNull(), F.col(c)).otherwise(kept).alias(c) if c == text_column else F.col(c)
            for c in source.columns
        ],
        F.coalesce(F.size(F.filter(split, lambda x: F.trim(x, blank) != "")), F.lit(0)).alias(n_lines),
        F.coalesce(F.size(removed), F.lit(0)).alias(n_removed),
    )
