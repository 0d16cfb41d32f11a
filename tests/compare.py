"""Differential check: a Spark query against its DuckDB SQL twin.

Compares row count, column names, column families and every value after an
order-insensitive sort (floats compared with a tiny relative tolerance).
"""

from __future__ import annotations

import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return ("nan",)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def _close(a, b, exact: bool = False) -> bool:
    if exact:
        return a == b
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        if isinstance(a, bool) or isinstance(b, bool):
            return a == b
        a, b = float(a), float(b)
        if math.isinf(a) or math.isinf(b):
            return a == b
        return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


def compare(spark_df, con, sql: str, exact: bool = False) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(v) for v in r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_sorted = sorted((tuple(r[i] for i in order) for r in s_rows), key=_key)
    d_sorted = sorted((tuple(r[d_index[s_cols[i]]] for i in order) for r in d_rows), key=_key)
    names = [s_cols[i] for i in order]
    for a, b in zip(s_sorted, d_sorted):
        for n, x, y in zip(names, a, b):
            if not _close(x, y, exact):
                return False, f"value differs in {n}: spark={x!r} duck={y!r}\n  spark row={a}\n  duck row ={b}"
    return True, f"{len(s_rows)} rows"
