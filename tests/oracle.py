"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows(cols: list[str], data: list) -> list:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def differences(spark, query, sql: str, sf_dir: str) -> str:
    """'' when both sides agree."""
    df = query(spark, sf_dir)
    got_cols, got = df.columns, [list(r) for r in df.collect()]
    cur = duck(sf_dir).execute(sql)
    want_cols, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = rows(got_cols, got), rows(want_cols, want)
    if a == b:
        return ""
    sa, sb = set(map(repr, a)), set(map(repr, b))
    return f"rows {len(a)} vs {len(b)}; only Spark: {sorted(sa - sb)[:2]!s:.700}; only SQL: {sorted(sb - sa)[:2]!s:.700}"
