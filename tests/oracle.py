"""Compare a Spark result with DuckDB on the same tables, row for row."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    if isinstance(v, Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _sort_key(row):
    return [(v is None, type(v).__name__ if isinstance(v, str) else "", str(v)) for v in row]


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(
        (tuple(_value(r[n]) for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect()),
        key=_sort_key,
    )


def duck_rows(con, sql: str):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_value(row[i]) for i in order) for row in cur.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=_sort_key)


def differences(df, con, sql: str) -> list[str]:
    """What differs, empty when equal. Types must agree up to the width of numbers."""
    names, ours = spark_rows(df)
    theirs_names, theirs = duck_rows(con, sql)
    if names != theirs_names:
        return [f"columns {names} vs {theirs_names}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} vs {len(theirs)}"]
    out = []
    for a, b in zip(ours, theirs):
        if a != b or any(type(x) is not type(y) for x, y in zip(a, b)):
            out.append(f"{[(n, x, y) for n, x, y in zip(names, a, b) if x != y or type(x) is not type(y)]}")
            if len(out) == 3:
                break
    return out
