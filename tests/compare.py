"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd

from tidepool.sources.tables import TABLES


def duckdb_frame(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).df()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame, rel_tol: float = 0.0) -> tuple[bool, str]:
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return False, f"columns differ: {sorted(spark_df.columns)} vs {sorted(oracle_df.columns)}"
    if len(spark_df) != len(oracle_df):
        return False, f"row counts differ: {len(spark_df)} vs {len(oracle_df)}"
    a, b = _rows(spark_df), _rows(oracle_df)
    for ra, rb in zip(a, b):
        if ra != rb:
            if rel_tol and all(
                    x == y or (isinstance(x, float) and isinstance(y, float)
                               and abs(x - y) <= rel_tol * max(abs(x), abs(y), 1.0))
                    for x, y in zip(ra, rb)):
                continue
            return False, f"first differing row: {ra} vs {rb}"
    return True, ""
