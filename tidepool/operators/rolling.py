"""Rolling (running) keyed aggregates: one updated result per input row.

Batch form: every row carries the aggregate of its key up to and including
itself, in an explicit order (tables have no arrival order).  The work is
spread over order-range chunks (see :mod:`tidepool.operators.ordered`).
Streaming form: :func:`tidepool.streaming.operators.stream_rolling`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_totals


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rolling_count(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  name: str = "running_count", n_chunks: int | None = None) -> DataFrame:
    """Running number of rows per key (a keyed sum of ones)."""
    return running_totals(df, keys, order, count_name=name, n_chunks=n_chunks)


def rolling_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value,
                name: str = "running_sum", n_chunks: int | None = None) -> DataFrame:
    return running_totals(df, keys, order, sums={name: _c(value)}, n_chunks=n_chunks)


def rolling_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], value,
                   firsts: Sequence[str] = (), sum_name: str = "running_sum",
                   count_name: str = "running_count", n_chunks: int | None = None) -> DataFrame:
    """Keyed reduce that adds up one field and a count and keeps the first
    row's other fields (``first_<col>``)."""
    return running_totals(df, keys, order, sums={sum_name: _c(value)}, count_name=count_name,
                          firsts=firsts, n_chunks=n_chunks)


def rolling_avg(df: DataFrame, keys: Sequence[str], order: Sequence[str], value,
                name: str = "running_avg", n_chunks: int | None = None,
                keep_parts: bool = False) -> DataFrame:
    """Running average = running sum / running count, as double."""
    out = running_totals(df, keys, order, sums={"_rsum": _c(value)}, count_name="_rcnt",
                         n_chunks=n_chunks)
    out = out.withColumn(name, F.col("_rsum").cast("double") / F.col("_rcnt").cast("double"))
    if keep_parts:
        return out.withColumnRenamed("_rsum", "running_sum").withColumnRenamed("_rcnt", "running_count")
    return out.drop("_rsum", "_rcnt")


__all__ = ["rolling_count", "rolling_sum", "rolling_reduce", "rolling_avg"]
