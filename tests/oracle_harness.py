"""Spark result vs DuckDB oracle: row count, column names, order-insensitive value hash."""

from __future__ import annotations

import hashlib
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, name + '.parquet')}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(v) if os.environ.get("ORACLE_EXACT") else repr(round(v, 6))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in records)


def compare(spark_df, sql: str, con) -> dict:
    srows = [tuple(r) for r in spark_df.collect()]
    scols = spark_df.columns
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    ha = hashlib.sha256("\n".join(a).encode()).hexdigest()
    hb = hashlib.sha256("\n".join(b).encode()).hexdigest()
    diff = []
    if ha != hb:
        sa, sb = set(a), set(b)
        diff = [("spark", x) for x in list(sa - sb)[:3]] + [("duck", x) for x in list(sb - sa)[:3]]
    return {"rows": (len(srows), len(drows)), "cols_match": sorted(scols) == sorted(dcols),
            "cols": (sorted(scols), sorted(dcols)) if sorted(scols) != sorted(dcols) else None,
            "hash_match": ha == hb, "diff": diff}
