"""Spark-vs-DuckDB comparison used by the tests (row count, column names
and an order-insensitive hash of the values, columns sorted by name)."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer():
            return int(v)
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def fingerprint(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = sorted(repr(tuple(_norm(x) for x in r)) for r in
                  pdf[cols].astype(object).where(pdf[cols].notna(), None).itertuples(index=False))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(pdf), cols, h


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    fs, fd = fingerprint(s), fingerprint(d)
    return {"rows": (fs[0], fd[0]), "cols_equal": fs[1] == fd[1], "hash_equal": fs[2] == fd[2],
            "spark_cols": fs[1], "oracle_cols": fd[1]}
