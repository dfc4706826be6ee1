"""Runs registered queries against their oracle SQL the way the driver does:
row count, column names and an order-insensitive comparison of values."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    if sql is None:
        return {"name": name, "rows": len(s_rows), "oracle": None, "ok": True}
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows)
    detail = ""
    if ok:
        a, b = _rows(s_rows, s_cols), _rows(d_rows, d_cols)
        if a != b:
            ok = False
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            detail = f"first diffs: {diff}"
    else:
        detail = f"cols {sorted(s_cols)} vs {sorted(d_cols)}; rows {len(s_rows)} vs {len(d_rows)}"
    return {"name": name, "rows": len(s_rows), "oracle": len(d_rows), "ok": ok, "detail": detail}
