"""Split one feed into several typed outputs (side outputs as complementary filters)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_even(df: DataFrame, col: str, keep: Sequence[str] = (), name: str = "value") -> DataFrame:
    """Even values, emitted as strings."""
    return df.where(F.col(col) % 2 == 0).select(*keep, F.col(col).cast("string").alias(name))


def split_odd(df: DataFrame, col: str, keep: Sequence[str] = (), name: str = "value") -> DataFrame:
    """Everything not even, kept as numbers.  ``%`` keeps the dividend's sign,
    so negative odd numbers (remainder -1) land here too; nulls go nowhere."""
    return df.where(F.col(col) % 2 != 0).select(*keep, F.col(col).alias(name))


def split_parity(df: DataFrame, col: str, keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All three outputs of the split: the main pass-through and both sides.
    Each is an independent plan over the same source; with several sinks
    write them from one ``foreachBatch`` over a persisted batch instead."""
    return {"main": df, "even": split_even(df, col, keep), "odd": split_odd(df, col, keep)}


__all__ = ["split_even", "split_odd", "split_parity"]
