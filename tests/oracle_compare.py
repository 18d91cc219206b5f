"""Compare a Spark query with its DuckDB oracle: row count, column names and an
order-insensitive hash of normalised values (what the driver's gate checks)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os

import duckdb
import numpy as np

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(root, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float | np.floating):
        f = float(v)
        return None if math.isnan(f) else round(f, 6)
    if isinstance(v, np.integer | bool | np.bool_):
        return int(v)
    if isinstance(v, int):
        return v
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(normed).encode()).hexdigest()
    return [columns[i] for i in order], len(rows), h


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    return _digest(df.columns, rows)


def duck_digest(con, sql: str):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return _digest(cols, cur.fetchall())


def compare(spark, con, root: str, fn, sql: str) -> dict:
    s_cols, s_n, s_h = spark_digest(fn(spark, root))
    d_cols, d_n, d_h = duck_digest(con, sql)
    return {"columns": s_cols == d_cols, "rows": s_n == d_n, "hash": s_h == d_h,
            "spark": (s_cols, s_n), "duck": (d_cols, d_n)}
