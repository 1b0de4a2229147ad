"""Run a streaming plan to a durable sink and read the result back as a table.

Checkpoints and sink files live under the shared checkpoint root
(``spark.checkpoint.dir``), so a restarted driver or lost executor resumes
from the commit log instead of starting over.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import session as S
from ..functions.time import ntz_to_instant
from ..sources.files import parquet_stream
from ..sources.tables import events_schema

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Stateful processors need the RocksDB state store; it also keeps large
    state off the JVM heap.  Changelog checkpointing commits only the changed
    keys per micro-batch instead of a snapshot.  Applies to queries started
    afterwards (a checkpoint keeps the provider it was created with)."""
    for key, value in (("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER),
                       (CHANGELOG, "true")):
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


# Session settings of the catalogue's streams: rate limits per micro-batch.
FILES_PER_TRIGGER = "tidepool.stream.maxFilesPerTrigger"
BYTES_PER_TRIGGER = "tidepool.stream.maxBytesPerTrigger"
DEFAULT_BYTES_PER_TRIGGER = 64 << 30


class LateRowsDropped(RuntimeError):
    """The input's disorder between micro-batches exceeded what the query can put in order:
    the watermark delay, or none at all for per-record results already written."""


def _is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()


def event_stream(spark: SparkSession, folder: str, glob: str = "events.parquet",
                 max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: int | None = None) -> DataFrame:
    """``events`` files of a folder as a stream, with an instant-typed event time
    ``evt`` (watermarks need ``timestamp``) and the integer ``volume``.

    A table that is a folder of part files is streamed from that folder; only
    a single file needs the name filter on its parent.  Without explicit limits
    the session settings above bound a micro-batch.  Files are taken in
    modification-time order.
    """
    if max_files_per_trigger is None:
        limit = spark.conf.get(FILES_PER_TRIGGER, None)
        max_files_per_trigger = int(limit) if limit else None
    if max_files_per_trigger is None and max_bytes_per_trigger is None:
        max_bytes_per_trigger = int(spark.conf.get(BYTES_PER_TRIGGER, str(DEFAULT_BYTES_PER_TRIGGER)))
    if glob == "events.parquet":
        schema = events_schema(spark, folder)
        table = f"{folder.rstrip('/')}/{glob}"
        if _is_folder(spark, table):
            folder, glob = table, None
    else:
        schema = spark.read.option("pathGlobFilter", glob).parquet(folder).schema
    return with_event_columns(parquet_stream(spark, folder, schema, glob, max_files_per_trigger, max_bytes_per_trigger))


def with_event_columns(events: DataFrame) -> DataFrame:
    """Adds the instant-typed event time ``evt`` and the integer ``volume`` to rows of ``events``."""
    return events.withColumn("evt", ntz_to_instant("ts")) \
                 .withColumn("volume", F.get_json_object("props", "$.k").cast("int"))


class _LateRows(StreamingQueryListener):
    """Rows that one query's stateful operators drop as late, summed over all its progress reports."""

    def __init__(self) -> None:
        self.by_run: dict[str, int] = {}
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        with self.changed:
            run = str(event.progress.runId)
            self.by_run[run] = self.by_run.get(run, 0) + late

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of(self, run: str, timeout_s: float = 60.0) -> int:
        """Late rows of an ended run, once all its reports are in."""
        with self.changed:
            if not self.changed.wait_for(lambda: run in self.ended, timeout_s):
                raise RuntimeError("the query's end was not reported; late rows are not known")
            return self.by_run.get(run, 0)


def late_rows(spark: SparkSession, writer, folder: str | None = None, timeout_s: float | None = None) -> int:
    """Start a stream writer, wait for its end and return the rows that it dropped as late."""
    listener = _LateRows()
    spark.streams.addListener(listener)
    try:
        query = writer.start(folder) if folder else writer.start()
        query.awaitTermination(timeout_s)
        if query.exception() is not None:
            raise query.exception()
        if query.isActive:  # the timeout came first
            return 0
        return listener.of(str(query.runId))
    finally:
        spark.streams.removeListener(listener)


def run_to_parquet(df: DataFrame, name: str, output_mode: str = "append",
                   path: str | None = None, partition_by: list[str] | None = None,
                   timeout_s: float | None = None, fail_on_late: bool = False) -> str:
    """Process everything available now (possibly several micro-batches plus a
    closing no-data batch) into Parquet files; returns the output folder.

    State partitions are the session's shuffle partitions at the first start
    (the checkpoint keeps them): set them for the cluster's full size.  With
    ``fail_on_late`` the run raises if any row was dropped behind the watermark.
    Rows out of an order that a stateful operator needs always raise.
    """
    spark = df.sparkSession
    out = path or S.scratch_path(spark, name)
    writer = (df.writeStream.format("parquet").outputMode(output_mode)
              .option("checkpointLocation", f"{out}/_checkpoint")
              .trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        late = late_rows(spark, writer, out, timeout_s)
    except StreamingQueryException as failed:
        if (said := re.search(rf"{LateRowsDropped.__name__}: (.*)", str(failed))) is None:
            raise
        raise LateRowsDropped(f"{name}: {said[1]}") from failed
    if fail_on_late and late:
        raise LateRowsDropped(f"{name}: {late} rows came later than the watermark delay; "
                              "raise the delay or the rate limit, or order the files by time")
    return out


def run_foreach_batch(df: DataFrame, name: str, handler: Callable[[DataFrame, int], None],
                      output_mode: str = "append", timeout_s: float | None = None) -> None:
    """Several sinks from one stream: ``handler(batch_df, epoch_id)`` per
    micro-batch (persist the batch inside when writing it more than once)."""
    spark = df.sparkSession
    ckpt = S.scratch_path(spark, name)
    writer = (df.writeStream.outputMode(output_mode).foreachBatch(handler)
              .option("checkpointLocation", ckpt).trigger(availableNow=True))
    query = writer.start()
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise query.exception()


BATCH = "batch"


def whole_batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the ``batch=N`` folders below ``folder`` that were written to their end, ascending."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    path = at(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith(f"{BATCH}=")]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(at(p, "_SUCCESS")))


def read_back(spark: SparkSession, folder: str, schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(folder)


__all__ = ["use_rocksdb_state", "event_stream", "with_event_columns", "late_rows", "LateRowsDropped", "run_to_parquet", "run_foreach_batch", "BATCH", "whole_batches", "read_back", "STATE_PROVIDER"]
