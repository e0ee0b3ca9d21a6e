"""Derived metrics, all safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MILLION = 1_000_000


def zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def number(c: str) -> Column:
    """Double, or null where the text is not a number or is NaN."""
    value = F.col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def whole_number(c: str) -> Column:
    """Long, truncating decimals, null where the text is not a number."""
    return number(c).try_cast("long")


def clip_negative(c: Column) -> Column:
    """Negative to 0; null stays null."""
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def increment_or_zero(c: Column) -> Column:
    """Null and negative to 0."""
    return F.greatest(zero(c), F.lit(0.0))


def open_cases(df: DataFrame) -> Column:
    """Confirmed minus deceased minus recovered, from the running totals, >= 0."""
    total = zero(F.col("cumulative_confirmed")) - zero(F.col("cumulative_deceased"))
    if "cumulative_recovered" in df.columns:
        total = total - zero(F.col("cumulative_recovered"))
    return F.greatest(total, F.lit(0.0))


def latest(value: Column, date: str = "date") -> Column:
    """The value of the latest row; a row without a date counts as earliest.

    ``max_by`` on fixed-width values keeps the hash aggregate and its map-side
    combine, where a window would sort and ship every row.
    """
    when = F.coalesce(F.col(date), F.lit("0001-01-01").cast("date"))
    return F.max_by(value, when)


def fatality_rate(deceased: str, confirmed: str) -> Column:
    """Percent of confirmed that died; the guard keeps the divisor non-zero."""
    divisor = F.when(F.col(confirmed) > 0, F.col(confirmed)).otherwise(F.lit(1))
    return F.round(F.col(deceased) / divisor * 100, 4)


def positive(c: str) -> Column:
    """The value when above zero, else null: a divisor that cannot fail."""
    return F.when(F.col(c) > 0, F.col(c))


def non_zero(c: str) -> Column:
    return F.when(F.col(c) != 0, F.col(c))


def per_million(total: str, population: str = "population") -> Column:
    """Rounded to 2; null when the population is unknown or not positive."""
    return F.round(F.col(total) / (positive(population) / MILLION), 2)


def per_million_raw(total: str, population: str = "population") -> Column:
    return F.col(total) / (non_zero(population) / MILLION)


def per_hundred(total: str, population: str = "population") -> Column:
    return F.col(total) / (non_zero(population) / 100)


def estimated_open_cases(confirmed: str, deceased: str, recovered: str) -> Column:
    """Known recoveries give the difference; otherwise 5 % of the total is assumed open."""
    known = F.greatest(
        F.col(confirmed) - F.col(deceased) - F.col(recovered), F.lit(0.0)
    )
    return F.when(F.col(recovered) > 0, known).otherwise(
        F.bround(F.col(confirmed) * 0.05, 0)
    )


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of ``names`` the frame has: metric choice by preference."""
    return next((n for n in names if n in df.columns), None)


def dose_metric(df: DataFrame) -> str | None:
    return first_present(
        df,
        ["total_vaccine_doses_administered", "total_people_vaccinated", "total_vaccinated"],
    )
