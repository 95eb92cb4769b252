"""Compare a registry query with its DuckDB oracle (same idea as the driver's
gate: column names, row count, order-insensitive values)."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, digits)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list | tuple):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def rows_of(columns, rows, digits: int):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "float": "FLOAT",
}


def type_mismatches(spark_dtypes: list[tuple[str, str]], con, sql: str) -> dict:
    duck_types = {c[0]: str(c[1]) for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (t, duck_types.get(c)) for c, t in spark_dtypes if SPARK_TO_DUCK.get(t, t) != duck_types.get(c)}


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, digits: int = 6) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    out = {"query": name, "spark_rows": len(s_rows), "columns": sorted(s_cols)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(d_cols) != sorted(s_cols):
        out["status"] = f"column mismatch spark={sorted(s_cols)} oracle={sorted(d_cols)}"
        return out
    bad_types = type_mismatches(df.dtypes, con, sql)
    if bad_types:
        out["status"] = f"type mismatch {bad_types}"
        return out
    a = rows_of(s_cols, s_rows, digits)
    b = rows_of(d_cols, d_rows, digits)
    if a == b:
        out["status"] = "match"
    else:
        only_s = list((a - b).items())[:3]
        only_d = list((b - a).items())[:3]
        out["status"] = f"value mismatch: spark-only={only_s} oracle-only={only_d}"
    return out
