"""Results kept in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors reach")
        folder = tempfile.mkdtemp(prefix="epiledger-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame computed once and read back, so a lost executor cannot change it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


_scopes: list[list[str]] = []


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`as_table` makes inside are deleted at the end."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def as_table(df: DataFrame, name: str, partition_by: str | None = None, kept: bool = False) -> DataFrame:
    """The frame written once as columnar files and scanned by every reader.

    Unlike a cache it survives lost executors, does not compete for memory, and
    lets each reader prune columns and partitions.  A ``kept`` one outlasts the innermost
    :func:`scratch_tables` around it.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    scopes = _scopes[:-1] if kept else _scopes
    if scopes:
        scopes[-1].append(path)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
