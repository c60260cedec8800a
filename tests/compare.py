"""Spark-vs-DuckDB comparison in the shape of the driver's correctness gate."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def frame_rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    out = {"spark_rows": len(s), "oracle_rows": len(d),
           "spark_cols": sorted(s.columns), "oracle_cols": sorted(d.columns)}
    out["cols_match"] = out["spark_cols"] == out["oracle_cols"]
    out["rows_match"] = len(s) == len(d)
    if out["cols_match"]:
        out["dtypes"] = {c: (str(s[c].dtype), str(d[c].dtype)) for c in out["spark_cols"]
                         if str(s[c].dtype) != str(d[c].dtype)}
    if out["cols_match"] and out["rows_match"]:
        a, b = frame_rows(s), frame_rows(d)
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        out["values_match"] = not diffs
        out["first_diffs"] = diffs[:3]
    else:
        out["values_match"] = False
    return out
