"""Compares a Spark result with the rows an SQL engine gives for the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) or "" for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns and all values agree; otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _sorted_rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    actual = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return [f"{len(actual)} rows instead of {len(expected)}"]
    return [f"{a} instead of {e}" for a, e in zip(actual, expected) if a != e][:5]
