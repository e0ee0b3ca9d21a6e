"""Row-level normalisation: one clean row per date and location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from epiledger.functions.metrics import clip_negative, number
from epiledger.schema import CLEANED_METRICS, KEY_COLUMNS


def drop_missing_keys(df: DataFrame) -> DataFrame:
    return df.dropna(subset=KEY_COLUMNS)


def cast_metrics(df: DataFrame, metrics: Sequence[str] = CLEANED_METRICS) -> DataFrame:
    present = [c for c in metrics if c in df.columns]
    return df.withColumns({c: number(c) for c in present})


def clip_metrics(df: DataFrame, metrics: Sequence[str] = CLEANED_METRICS) -> DataFrame:
    present = [c for c in metrics if c in df.columns]
    return df.withColumns({c: clip_negative(F.col(c)) for c in present})


def parse_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Text ``yyyy-MM-dd`` to a date, null where it is none; typed dates pass through."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return df
    if isinstance(kind, T.StringType):
        return df.withColumn(column, F.try_to_date(column, "yyyy-MM-dd"))
    return df.withColumn(column, F.col(column).cast("date"))


def dedupe(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """Keep one row per key: the first by ``order_by``, nulls last.

    Without ``order_by`` the other columns decide, in their order, nulls last, so the
    choice does not depend on how the rows arrive.  The rank filter becomes a group limit that
    runs before the shuffle too: a key holding a third of all rows sends one row
    per map task.
    """
    order = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order_by or []]
    if not order:
        order = [F.asc_nulls_last(c) for c in df.columns if c not in keys] or [F.lit(0)]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_rows(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """The whole latest row per key, ties broken by the remaining columns."""
    rest = [F.asc_nulls_last(c) for c in df.columns if c != date and c not in keys]
    return dedupe(df, keys, [F.desc_nulls_last(date), *rest])


def fill_metrics(df: DataFrame, metrics: Sequence[str] = CLEANED_METRICS) -> DataFrame:
    present = [c for c in metrics if c in df.columns]
    return df.fillna(0.0, subset=present) if present else df


def fill_all_numeric(df: DataFrame) -> DataFrame:
    return df.fillna(0.0)


def clean(
    df: DataFrame,
    order_by: Sequence[str | Column] | None = None,
    drop_bad_dates: bool = False,
) -> DataFrame:
    """Drop keyless rows, cast, clip, parse the date, dedupe, fill.

    A date that cannot be read turns null *after* the missing-key check, so such
    rows survive as one null-date row per location unless ``drop_bad_dates``.
    """
    out = parse_date(clip_metrics(cast_metrics(drop_missing_keys(df))))
    if drop_bad_dates:
        out = out.dropna(subset=["date"])
    return fill_metrics(dedupe(out, KEY_COLUMNS, order_by))
