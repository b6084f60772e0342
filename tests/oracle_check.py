"""Compare every registered query with its DuckDB twin."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by all values: order is not compared."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    keyed = frame.map(lambda v: repr(float(v)) if isinstance(v, (int, float)) else repr(v))
    return keyed.sort_values(list(keyed.columns)).reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(oracle_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(oracle_frame.columns)}"
    if len(spark_frame) != len(oracle_frame):
        return f"rows {len(spark_frame)} != {len(oracle_frame)}"
    ours, theirs = normal(spark_frame), normal(oracle_frame)
    if ours.equals(theirs):
        return None
    wrong = (ours != theirs).any(axis=1)
    return f"{int(wrong.sum())} rows differ, e.g.\n{ours[wrong].head(3)}\n{theirs[wrong].head(3)}"
