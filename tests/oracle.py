"""Spark results against DuckDB on the same tables."""

import glob
import numbers
import os

import duckdb
import pandas as pd


def connect(folder: str):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(x):
    if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
        return "null"
    if isinstance(x, bool) or type(x).__name__ == "bool_":
        return str(bool(x))
    if isinstance(x, numbers.Number):
        return repr(round(float(x), 6) + 0.0)
    s = str(x)
    return s[:10] if hasattr(x, "year") and s.endswith("00:00:00") else s


def rows(df: pd.DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted(zip(*([plain(x) for x in df[c].astype(object)] for c in names)))
