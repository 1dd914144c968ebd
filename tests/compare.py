"""Exact comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _key(value):
    if value is None:
        return "\0"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    result = connection.execute(sql)
    expected_columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    expected = rows_of(expected_columns, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(bad)} of {len(actual)} rows differ, first: {bad[0]}" if bad else None
