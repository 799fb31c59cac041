"""Compare a Spark result with a DuckDB statement: rows, columns and values."""

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
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0  # exact; only -0.0 becomes 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):  # Decimal
        return round(float(v), 6)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    sc, sv = rows_of(s_cols, s_rows)
    dc, dv = rows_of(d_cols, d_rows)
    return {
        "rows_spark": len(s_rows),
        "rows_sql": len(d_rows),
        "columns_match": sc == dc,
        "values_match": sc == dc and sv == dv,
        "spark_only": list((sv - dv).items())[:3],
        "sql_only": list((dv - sv).items())[:3],
        "columns": (sc, dc),
    }
