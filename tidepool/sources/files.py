"""File sources, batch and streaming: text lines, CSV folders, JSON lines, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """``DataFrame[value: string]`` of the lines of a file or folder."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def csv_table(spark: SparkSession, path: str, schema, header: bool = True, sep: str = ",",
              streaming: bool = False, date_format: str | None = None) -> DataFrame:
    """Typed CSV over a folder; with ``header`` the first line of each file is skipped."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(schema).option("header", header).option("sep", sep)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    return reader.csv(path)


def json_lines(spark: SparkSession, path: str, schema, streaming: bool = False,
               mode: str = "PERMISSIVE") -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).option("mode", mode).json(path)


def parquet_stream(spark: SparkSession, folder: str, schema, glob: str | None = None,
                   max_files_per_trigger: int | None = None,
                   max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream (each new file is new input).

    ``glob`` restricts the files, e.g. ``events.parquet`` to stream one table
    out of a folder that holds many, without copying it.
    """
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(folder)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Line feed from a TCP socket (for users with a live feed; not used in tests)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


__all__ = ["text_lines", "csv_table", "json_lines", "parquet_stream", "socket_lines"]
