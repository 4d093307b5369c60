"""Compare registered queries with their oracle SQL: names, row counts and values."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _lines(names, rows):
    places = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        ([_plain(row[i]) for i in places] for row in rows), key=lambda line: [repr(v) for v in line]
    )


def differences(df, connection, sql) -> list[str]:
    """Empty when the two results agree, values compared exactly."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    ours, theirs = _lines(df.columns, df.collect()), _lines(names, result.fetchall())
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    return [f"{a} against {b}" for a, b in zip(ours, theirs) if a != b][:3]
