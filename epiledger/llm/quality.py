"""Quality rules as a short-circuit cascade; DataFrame functions only."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiledger.sources.shared import as_table

SPACE = "[\\\\x20\\\\x09-\\\\x0D]"

# Each rule names what it rejects, over the text and the measures of :func:`with_measures`.
RULES = {
    "many_symbols": "n_symbols * 10 > n_words",
    "long_or_short_words": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
    "repeated_lines": "n_dup_lines > 3 AND n_dup_lines * 10 > 3 * (1 + length(text) - length(replace(text, '\n', '')))",
    "shouting": "regexp_count(text, '!!') * 10 > n_words",
    "capitals": "regexp_count(text, '[A-Z]') * 2 > word_chars",
}


def with_measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, the text and the measures of each document.

    Repeated three-word windows are found by sorting, in the document's own row, longs that
    hold the upper bits of a window's hash and its place; neighbours with equal 64-bit hashes
    repeat.  Nothing is exploded or shuffled.
    """
    words = f"filter(split(text, '{SPACE}+'), w -> w <> '')"
    lines = f"filter(split(text, '\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    low = "(shiftleft(1L, length(bin(n_windows))) - 1)"
    hashed = "get(hashes, cast(get(sorted, {}) & low AS int))"
    repeats = (
        f"filter(sorted, (x, i) -> coalesce({hashed.format('i')} = {hashed.format('i + 1')}, false)"
        f" OR coalesce({hashed.format('i')} = {hashed.format('i - 1')}, false))"
    )
    return (
        docs.select(
            F.col(id_column).alias("id"),
            F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        )
        .selectExpr("id", "text", f"{words} AS words", f"{lines} AS lines")
        .selectExpr(
            "id", "text", "cast(size(words) AS bigint) AS n_words",
            "cast(length(array_join(words, '')) AS bigint) AS word_chars",
            "cast(regexp_count(text, '[#*$%&|<>]') AS bigint) AS n_symbols",
            "cast(size(lines) - size(array_distinct(lines)) AS bigint) AS n_dup_lines",
            "IF(size(words) > 2, transform(slice(words, 1, size(words) - 2), (w, i) -> "
            "xxhash64(w, get(words, i + 1), get(words, i + 2))), array()) AS hashes",
        )
        .selectExpr("*", "cast(size(hashes) AS bigint) AS n_windows")
        .selectExpr("*", f"{low} AS low")
        .selectExpr("*", "sort_array(transform(hashes, (h, i) -> (h & ~low) | i)) AS sorted")
        .selectExpr("*", f"sort_array(transform({repeats}, x -> x & low)) AS repeats")
        .selectExpr(
            "id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines",
            "aggregate(transform(repeats, (p, i) -> least(3L, coalesce(get(repeats, i + 1) - p, 3L))),"
            " 0L, (total, x) -> total + x) AS n_repeat_words",
        )
        .selectExpr(
            "*", "n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed"
        )
    )


def rule_order(sample: DataFrame, rules: dict[str, str]) -> list[str]:
    """Rule names by rejected rows per second on the sample, most first.

    The cost of a rule is the time of a count by it over the stored sample, less that of a plain count.
    """

    def run(condition: str) -> tuple[int, float]:
        began = time.perf_counter()
        rejected = sample.selectExpr(f"count_if({condition})").first()[0]
        return rejected, time.perf_counter() - began

    run("false"), run("n_words < 0 OR text IS NULL")
    idle = run("n_words < 0 OR text IS NULL")[1]
    rate = {}
    for name, condition in rules.items():
        rejected, seconds = run(condition)
        rate[name] = rejected / max(seconds - idle, 1e-3)
    return sorted(rules, key=lambda name: (-rate[name], name))


def judge(
    docs: DataFrame,
    rules: dict[str, str] = RULES,
    sample_rows: int = 2000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: its measures, ``base_failed`` and ``kept``.

    A document is kept if it passes the base rule and no rule of the cascade rejects it.  Rules
    are tried in the order of :func:`rule_order` and the first that rejects ends the cascade, so
    dear rules run only on what cheap ones let pass.  The order is estimated on about
    ``sample_rows`` rows and changes the cost, never the verdict.

    A null text counts as empty and fails, having under 50 words.  Repeated rows and null ids are
    kept as rows.  Of an empty table the result is empty.  Other columns are not read.
    """
    measured = with_measures(docs, id_column, text_column)
    total = docs.count()
    share = min(1.0, sample_rows / max(total, 1))
    sample = as_table(with_measures(docs.sample(share, seed=1), id_column, text_column), "quality-sample")
    verdict: Column = F.when(F.col("base_failed"), F.lit(False))
    for name in rule_order(sample, rules):
        verdict = verdict.when(F.expr(rules[name]), F.lit(False))
    return measured.withColumn("kept", verdict.otherwise(F.lit(True))).drop("text")
