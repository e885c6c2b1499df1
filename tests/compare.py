"""Run a registered query and its SQL twin on the same tables and compare whole results."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return v


def _sort_key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=_sort_key)


def spark_result(df):
    return normal([tuple(r) for r in df.collect()], df.columns)


def duck_result(con, sql):
    cur = con.execute(sql)
    return normal(cur.fetchall(), [c[0] for c in cur.description])


def difference(df, con, sql) -> str | None:
    """None when equal, else a short description."""
    cols_a, rows_a = spark_result(df)
    cols_b, rows_b = duck_result(con, sql)
    if cols_a != cols_b:
        return f"columns {cols_a} != {cols_b}"
    if len(rows_a) != len(rows_b):
        return f"rows {len(rows_a)} != {len(rows_b)}; only here {sorted(set(rows_a) - set(rows_b), key=_sort_key)[:3]}; only sql {sorted(set(rows_b) - set(rows_a), key=_sort_key)[:3]}"
    bad = [(a, b) for a, b in zip(rows_a, rows_b) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(bad)} of {len(rows_a)} rows differ, first {bad[0]}" if bad else None
