"""DuckDB beside Spark on one folder of tables."""

import glob
import os

import duckdb
import pandas as pd


def rows(sql: str, folder: str):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c.sql(sql).df()


def plain(df):
    """Columns by name, values as text, rows in any order."""
    df = df[sorted(df.columns)]

    def said(v):
        if not isinstance(v, list | dict) and pd.isna(v):
            return "null"
        return f"{float(v):.9g}" if isinstance(v, int | float) or hasattr(v, "dtype") else str(v)

    return list(df.columns), sorted(tuple(map(said, r)) for r in df.values.tolist())
