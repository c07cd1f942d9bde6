"""Run a registered query in Spark and its SQL text in DuckDB and compare all rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from lakejobs.tables import BASE_TABLES


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value.normalize()))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if hasattr(value, "item"):
        return value.item()
    return value


def _sort_key(row):
    return tuple((v is None, str(type(v)), repr(v)) for v in row)


def spark_rows(df):
    order = sorted(df.columns)
    assert len(set(order)) == len(order), f"duplicate column names: {order}"
    rows = [tuple(plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in order]).collect()]
    return order, sorted(rows, key=_sort_key)


def oracle_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(names)
    picks = [names.index(c) for c in order]
    rows = [tuple(plain(row[i]) for i in picks) for row in result.fetchall()]
    return order, sorted(rows, key=_sort_key)


def compare(df, con, sql):
    """Return (row count, None) or (row count, reason)."""
    columns, rows = spark_rows(df)
    expected_columns, expected = oracle_rows(con, sql)
    if columns != expected_columns:
        return len(rows), f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return len(rows), f"rows {len(rows)} != {len(expected)}"
    for mine, other in zip(rows, expected):
        if mine != other:
            return len(rows), f"first difference {dict(zip(columns, mine))} != {dict(zip(columns, other))}"
    return len(rows), None
