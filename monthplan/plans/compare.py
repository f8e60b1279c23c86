"""Run a registered query and its SQL oracle side by side (the correctness gate, used by tests and by hand)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    """One comparable value: NULL/NaN -> None, midnight timestamps -> their date, floats to 9 places."""
    if v is None or (isinstance(v, float) and math.isnan(v)) or v is pd.NaT:
        return None
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):  # numpy scalars
        return _norm(v.item())
    if isinstance(v, float):
        return round(v, 9)
    return v


def frame_rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> dict:
    out = {"spark_rows": len(spark_df), "oracle_rows": len(oracle_df),
           "columns_match": sorted(spark_df.columns) == sorted(oracle_df.columns)}
    if not out["columns_match"]:
        out["spark_columns"] = sorted(spark_df.columns)
        out["oracle_columns"] = sorted(oracle_df.columns)
        out["values_match"] = False
        return out
    a, b = frame_rows(spark_df), frame_rows(oracle_df)
    out["values_match"] = a == b
    if not out["values_match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
    return out
