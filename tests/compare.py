"""Comparison of a Spark result with the DuckDB result of its oracle."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _normal(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, float):
        return value + 0.0
    return value


def rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    out = [tuple(_normal(v) for v in row) for row in zip(*columns)]
    return sorted(out, key=repr)


def difference(actual, expected) -> str | None:
    """None when equal, else a short description; both are Arrow tables."""
    if sorted(actual.column_names) != sorted(expected.column_names):
        return f"columns {sorted(actual.column_names)} != {sorted(expected.column_names)}"
    for name in actual.column_names:
        ours = str(actual.schema.field(name).type).replace("large_", "")
        theirs = str(expected.schema.field(name).type).replace("large_", "")
        if ours != theirs:
            return f"type of {name}: {ours} != {theirs}"
    left, right = rows(actual), rows(expected)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            return f"first difference:\n  spark  {a}\n  oracle {b}"
    return None
