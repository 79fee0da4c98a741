"""Compare a Spark DataFrame with DuckDB SQL on the same Parquet tables:
row count, column names, and an order-insensitive comparison of values
(doubles to 1e-9 relative)."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 6) if abs(v) < 1e12 else float(f"{v:.12g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_raw = rel.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duckdb={sorted(d_cols)}"
    d_rows = [tuple(_norm(r[idx[c]]) for c in sorted(d_cols)) for r in d_raw]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duckdb={len(d_rows)}"
    s_sorted = sorted(s_rows, key=_key)
    d_sorted = sorted(d_rows, key=_key)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"first differing row:\n spark ={a}\n duckdb={b}"
    return True, f"{len(s_rows)} rows equal"
