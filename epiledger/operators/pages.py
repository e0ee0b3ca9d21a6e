"""Pages of a sorted result by seeking past the last row seen, not by counting from the front."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from epiledger.sources.shared import as_table

ROW = "row"


def _order(sort: str, keys: Sequence[str], descending: bool) -> list[Column]:
    """Nulls of the sort column come last either way, nulls of keys too."""
    value = F.col(sort).desc_nulls_last() if descending else F.col(sort).asc_nulls_last()
    return [value, *[F.col(k).asc_nulls_last() for k in keys]]


def paged(df: DataFrame, sort: str, keys: Sequence[str], descending: bool = True) -> DataFrame:
    """The frame as a table sorted by value and keys, with each row's number from 0 in ``row``.

    Rows are dealt by ranges, so no task sorts more than its share, and a row's number is its place in
    its partition plus the rows of the partitions before: only one number a partition meets in one
    task.  Rows equal in value and keys are numbered in any order, once and for all, as the table is
    stored.  Files hold ranges of the sort column, so a seek reads few of them.
    """
    order = _order(sort, keys, descending)
    placed = as_table(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()),
        "page-places",
    )
    part = F.call_function("shiftright", "_place", F.lit(33))
    parts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_place") - F.call_function("shiftleft", F.col("_part"), F.lit(33))
    numbered = (
        placed.withColumn("_part", part).join(starts, "_part")
        .withColumn(ROW, (F.col("_start") + within).cast("long"))
        .drop("_part", "_place", "_start")
    )
    return as_table(numbered, "pages")


def page(table: DataFrame, number: int, size: int) -> DataFrame:
    """Page ``number`` from 0 of a table of :func:`paged`; a range of rows that prunes files."""
    return table.where(F.col(ROW).between(number * size, (number + 1) * size - 1)).orderBy(ROW)


def page_after(
    table: DataFrame,
    sort: str,
    keys: Sequence[str],
    size: int,
    last: Sequence[object] | None = None,
    descending: bool = True,
) -> DataFrame:
    """The ``size`` rows after the one with the given value, keys and row number; the first page for none.

    The row number decides only among rows equal in value and keys, so none is lost or shown twice
    at the seam of two pages.
    """
    order = [*_order(sort, keys, descending), F.col(ROW)]
    if last is None:
        return table.orderBy(*order).limit(size)
    beyond = F.col(ROW) > last[-1]
    for column, value in reversed(list(zip(keys, last[1:-1], strict=True))):
        beyond = _past(F.col(column), value, False, beyond)
    return table.where(_past(F.col(sort), last[0], descending, beyond)).orderBy(*order).limit(size)


def _past(column: Column, value: object, descending: bool, tied: Column) -> Column:
    """Rows whose column comes after the value, nulls last, or is equal where ``tied`` holds."""
    if value is None:
        return column.isNull() & tied
    further = column < F.lit(value) if descending else column > F.lit(value)
    return further | column.isNull() | ((column == F.lit(value)) & tied)
