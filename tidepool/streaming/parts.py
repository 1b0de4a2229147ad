"""Several file sinks of one stream, each row once in each of them.

A micro-batch's rows go to ``<root>/<sink>/batch=N/bucket=.../``: a folder of
its own for each sink and batch, in buckets by the hour of writing and parts of a
bounded number of rows.  A folder that was written to its end (Spark's success mark) is
the sink's record that it has the batch.  If a run dies between two sinks, the
batch is repeated: sinks that have it are left alone, so their rows keep the
bucket they got first, the others write it anew, over what a dead run left.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sinks.files import with_bucket
from .runners import BATCH, late_rows, whole_batches

ROWS_PER_PART = 1_000_000


def write_once(df: DataFrame, folder: str, epoch: int, rows_per_part: int = ROWS_PER_PART,
               file_format: str = "parquet") -> bool:
    """Write one micro-batch below ``folder`` unless it is there already; tells whether it was written."""
    if epoch in whole_batches(df.sparkSession, folder):
        return False
    (with_bucket(df).write.mode("overwrite")
     .option("maxRecordsPerFile", rows_per_part).partitionBy("bucket").format(file_format).save(f"{folder}/{BATCH}={epoch}"))
    return True


def fan_out(df: DataFrame, sinks: Mapping[str, Callable[[DataFrame], DataFrame]], root: str,
            rows_per_part: int = ROWS_PER_PART, file_format: str = "parquet", checkpoint: str = "_checkpoint") -> int:
    """Run a stream to its end into every sink; ``sinks`` gives each sink's rows of a micro-batch.

    The progress is kept below ``root``, so a later run goes on where the last one ended; several streams with
    the same ``root`` need a ``checkpoint`` name each.  Returns the number of rows dropped as late."""
    def handle(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for name, rows in sinks.items():
                write_once(rows(batch), f"{root}/{name}", epoch, rows_per_part, file_format)
        finally:
            batch.unpersist()

    return late_rows(df.sparkSession, df.writeStream.foreachBatch(handle)
                     .option("checkpointLocation", f"{root}/{checkpoint}").trigger(availableNow=True))


def written(spark: SparkSession, folder: str, file_format: str = "parquet") -> DataFrame:
    """All rows of a sink's whole batches, with ``batch`` and ``bucket``; a batch cut short is not read."""
    batches = whole_batches(spark, folder)
    if not batches:
        raise ValueError(f"no batch has been written to {folder}")
    return spark.read.format(file_format).option("basePath", folder).load([f"{folder}/{BATCH}={n}" for n in batches])


__all__ = ["ROWS_PER_PART", "write_once", "fan_out", "written"]
