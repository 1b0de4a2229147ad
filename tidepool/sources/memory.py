"""In-memory rows as a table: inferred schema, names only, or an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def rows(spark: SparkSession, data: Sequence, schema=None) -> DataFrame:
    """``schema`` may be None (inferred, columns ``_1, _2``), a list of names
    (types inferred) or a ``StructType`` / DDL string (explicit)."""
    return spark.createDataFrame(list(data), schema)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a frame addressable by name from SQL and ``spark.table``."""
    df.createOrReplaceTempView(name)
    return df


__all__ = ["rows", "register"]
