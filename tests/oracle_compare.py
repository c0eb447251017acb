"""Spark-vs-DuckDB comparison in the shape of the driver's correctness check.

For each query: row count, column names, and an order-insensitive hash of the
values (columns sorted by name, every value normalised to text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    return str(v)


def table_hash(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, name: str, build, sql: str, con=None) -> dict:
    df = build(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {
        "name": name,
        "rows": (len(s_rows), len(d_rows)),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": sorted(s_cols) == sorted(d_cols) and table_hash(s_cols, s_rows) == table_hash(d_cols, d_rows),
    }
    out["ok"] = out["rows"][0] == out["rows"][1] and out["columns_match"] and out["hash_match"]
    if not out["ok"]:
        out["spark_cols"], out["duck_cols"] = s_cols, d_cols
        s_set = {tuple(norm(r[s_cols.index(c)]) for c in sorted(s_cols)) for r in s_rows} if out["columns_match"] else set()
        d_set = {tuple(norm(r[d_cols.index(c)]) for c in sorted(d_cols)) for r in d_rows} if out["columns_match"] else set()
        out["only_spark"] = sorted(s_set - d_set)[:3]
        out["only_duck"] = sorted(d_set - s_set)[:3]
    return out
