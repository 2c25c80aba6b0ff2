"""Run registered queries against their SQL counterparts in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# Spark type -> DuckDB type of the same column.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _key(value) -> tuple:
    if value is None:
        return (0, "")
    if isinstance(value, float) and math.isnan(value):
        return (1, "")
    return (2, repr(value))


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty when names, types, row counts and values agree exactly."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    kinds = {d[0]: str(d[1]) for d in result.description}
    found = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        if TYPES.get(kind, kind) != kinds[name]:
            found.append(f"type of {name}: {kind} != {kinds[name]}")
    actual = [tuple(row) for row in spark_df.collect()]
    if len(actual) != len(expected):
        found.append(f"rows {len(actual)} != {len(expected)}")
        return found
    ours, theirs = _rows(spark_df.columns, actual), _rows(names, expected)
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        found.append(f"{len(different)} rows differ, first {different[0]}")
    return found
