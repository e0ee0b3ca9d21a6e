"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table.  Python workers import this package from where the driver does."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores in front until no column has it."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name = f"_{name}"
    return name


def in_fold(column: str, folds: int, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves the given remainder; a null id is in fold no one holds out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == fold, F.lit(False))


def row_key(id_column: str, text_column: str) -> Column:
    """A 16-byte key of a row: equal for rows that agree in id and text, nulls included."""
    part = lambda c: F.coalesce(F.md5(F.col(c).cast("string")), F.lit("null"))
    return F.unhex(F.md5(F.concat(part(id_column), part(text_column))))


def dealt(rows: DataFrame) -> DataFrame:
    """The frame as a side of a join that deals both sides out by key and sends neither whole.

    Spark takes an exploded table for little more than what it is made from, and part of a stored one for
    a share of its files by the types of columns.  Where either seems small it would gather it in the driver.
    """
    return rows.hint("merge")


def numbered(
    rows: DataFrame, within: list[str], order: list[Column | str], block: str, name: str
) -> DataFrame:
    """Numbers rows from 0 without gaps in each group of ``within``.

    ``block`` is a column that deals the rows into blocks of bounded size, such as
    :func:`block_of_rows`.  A row's number is its place in the block plus the rows of the
    blocks before, so a group of any size is never in one task.  The input is read twice and
    has to be the same both times: a stored table.
    """
    from pyspark.sql.window import Window

    before = Window.partitionBy(*within).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(block, *within)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(block, *within, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy(block, *within).orderBy(*order))
    return (
        rows.withColumn("_place", place)
        .join(starts, [block, *within])
        .withColumn(name, (F.col("_start") + F.col("_place") - 1).cast("long"))
        .drop("_place", "_start")
    )


def block_of_rows() -> Column:
    """At most 65,536 neighbouring rows of a partition; fixed once it is stored."""
    return F.shiftright(F.monotonically_increasing_id(), 16)


def slices(batch: pa.RecordBatch, text: int | str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of some bytes of text; a longer text is a slice of its own.

    What a task keeps of a slice is gone before the next, so its memory depends on bytes, not on rows.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    upto, at = np.cumsum(sizes.astype(np.int64) + 64), 0
    while at < batch.num_rows:
        end = int(np.searchsorted(upto, most + (upto[at - 1] if at else 0), "right"))
        yield batch.slice(at, max(end, at + 1) - at)
        at = max(end, at + 1)
