"""Side-by-side run of a query and its SQL twin."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from verification.oracles import ORACLES
from verification.queries import QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        tuple((type(row[i]).__name__, repr(row[i])) for i in order) for row in rows
    )


def differences(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str
) -> str | None:
    """None where both agree on columns, value types and values; else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    cursor = connection.execute(ORACLES[name])
    expected_columns = [c[0] for c in cursor.description]
    expected = _bag(expected_columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(expected_columns):
        return f"columns {sorted(set(frame.columns) ^ set(expected_columns))}"
    found = _bag(frame.columns, [tuple(r) for r in frame.collect()])
    if found == expected:
        return None
    extra, absent = list((found - expected).items()), list((expected - found).items())
    return (
        f"{sum(found.values())} rows against {sum(expected.values())}; "
        f"columns {sorted(frame.columns)}; only here {extra[:2]}; only there {absent[:2]}"
    )
