"""Run a registered query on Spark and its oracle SQL on DuckDB; compare results.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of all values.
"""

from __future__ import annotations

import math
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("f", repr(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("d", tuple(sorted((k, _norm(x)) for k, x in v.items())))
    return ("s", str(v))


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records), sorted(columns)


def compare(spark, sf_dir: str, name: str, fn, sql: str) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    s_sorted, s_names = rows_of(s_cols, s_rows)
    d_sorted, d_names = rows_of(d_cols, d_rows)
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": s_names == d_names,
        "values_match": s_sorted == d_sorted,
    }
    if not out["columns_match"]:
        out["spark_columns"], out["oracle_columns"] = s_names, d_names
    elif not out["values_match"]:
        diff_s = [r for r in s_sorted if r not in set(d_sorted)][:3]
        diff_d = [r for r in d_sorted if r not in set(s_sorted)][:3]
        out["only_spark"], out["only_oracle"] = diff_s, diff_d
    return out
