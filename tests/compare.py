"""Spark-vs-DuckDB comparison used by the tests and the local check script.

Row count, column names and an order-insensitive hash of the values
(columns sorted by name, doubles rounded to 9 significant digits).
"""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if glob.glob(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return None
        return float(f"{float(v):.9g}")
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"rows differ: spark={len(s)} oracle={len(o)}"
    a, b = canon(s), canon(o)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                return False, f"first differing row: spark={x} oracle={y}"
    return True, f"{len(s)} rows"
