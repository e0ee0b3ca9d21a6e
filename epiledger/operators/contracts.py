"""Rules on values: all of them checked in one aggregation, with example rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a row that breaks the rule; null counts as kept."""

    name: str
    fails: Column


def required(column: str) -> Rule:
    return Rule(f"{column} is there", F.col(column).isNull())


def castable(column: str, kind: str) -> Rule:
    """A value that is there reads as the type."""
    return Rule(f"{column} reads as {kind}", F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull())


def between(column: str, low: object, high: object) -> Rule:
    """A value that is there lies in the range, both ends included."""
    return Rule(f"{column} between {low} and {high}", ~F.col(column).between(low, high))


def one_of(column: str, values: Sequence[object]) -> Rule:
    return Rule(f"{column} is listed", ~F.col(column).isin(list(values)))


def shaped(column: str, pattern: str) -> Rule:
    return Rule(f"{column} has the shape {pattern}", ~F.col(column).rlike(pattern))


def at_most(column: str, other: str) -> Rule:
    """A value is no greater than that of another column."""
    return Rule(f"{column} at most {other}", F.col(column) > F.col(other))


def check_values(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str]) -> DataFrame:
    """One row per rule: rows checked, rows that fail, and the keys of the first and last that do.

    One more rule asks that keys are unique; of the rows that share a key all but one fail.  Rows are
    added up per key map-side, keys then to one row, so one scan and one shuffle serve all rules, and a
    key that holds most rows sends one row a task.  Keys are shown joined by ``|``, nulls as ``null``,
    and compared as columns, nulls first.  Of an empty frame every rule has 0 rows and fails none.
    """
    fails = {f"_fail_{k}": rule for k, rule in enumerate(rules)}
    shown = F.struct(*[F.col(f"_key_{k}") for k in range(len(keys))])
    per_key = df.groupBy(*[F.col(c).alias(f"_key_{k}") for k, c in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(rule.fails).alias(name) for name, rule in fails.items()]
    )

    def summed(failed: Column) -> list[Column]:
        broken = F.when(failed > 0, shown)
        return [F.coalesce(F.sum(failed), F.lit(0)), F.min(broken), F.max(broken)]

    figures = [*[(rule.name, F.col(name)) for name, rule in fails.items()], ("keys are unique", F.col("_n") - 1)]
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        *[
            part.alias(f"_{what}_{k}")
            for k, (_, failed) in enumerate(figures)
            for what, part in zip(("sum", "first", "last"), summed(failed), strict=True)
        ],
    )

    def text(key: Column) -> Column:
        parts = [F.coalesce(key[f"_key_{k}"].cast("string"), F.lit("null")) for k in range(len(keys))]
        return F.when(key.isNotNull(), F.concat_ws("|", *parts))

    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col("_rows").alias("checked"),
                F.col(f"_sum_{k}").alias("failed"),
                text(F.col(f"_first_{k}")).alias("first_key"),
                text(F.col(f"_last_{k}")).alias("last_key"),
            )
            for k, (name, _) in enumerate(figures)
        ]
    )
    return totals.select(F.explode(rows).alias("_r")).select("_r.*")
