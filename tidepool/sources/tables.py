"""The stored test tables (one Parquet file per table under an ``sf`` folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_all(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temp view (the SQL entry point)."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the integer ``volume`` carried in ``props`` ({"k": n})."""
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("volume", F.get_json_object("props", "$.k").cast("int"))


def events_schema(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "events").schema


__all__ = ["TABLES", "table", "register_all", "events", "events_schema"]
