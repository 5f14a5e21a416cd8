"""Compares a registered query with its check SQL on the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.date()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


SAME_KIND = {
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "date": {"DATE"},
    "boolean": {"BOOLEAN"},
}


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and values agree; otherwise what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} but expected {sorted(names)}"
    for name, kind in df.dtypes:
        if kinds[name] not in SAME_KIND.get(kind, {kinds[name]}):
            return f"column {name} is {kind} but expected {kinds[name]}"
    got = df.collect()
    if len(got) != len(expected):
        return f"{len(got)} rows but expected {len(expected)}"
    for mine, theirs in zip(_rows(df.columns, got), _rows(names, expected)):
        if mine != theirs:
            return f"row {mine} but expected {theirs} (columns {sorted(names)})"
    return None
