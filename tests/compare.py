"""Spark-vs-DuckDB comparison used by the tests and by hand:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

from skyfold.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6g}" if abs(v) >= 1e15 else f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return cols, lines, h


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sl, sh = canon(s_cols, s_rows)
    dc, dl, dh = canon(d_cols, d_rows)
    out = {
        "rows_spark": len(sl),
        "rows_oracle": len(dl),
        "cols_match": sc == dc,
        "hash_match": sh == dh and sc == dc,
    }
    if not out["hash_match"]:
        out["spark_cols"] = sc
        out["oracle_cols"] = dc
        only_s = sorted(set(sl) - set(dl))[:3]
        only_d = sorted(set(dl) - set(sl))[:3]
        out["only_spark"] = only_s
        out["only_oracle"] = only_d
    return out
