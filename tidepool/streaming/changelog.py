"""Continuous queries whose result rows change: a changelog, and the table that it stands for.

A grouped count or a distinct without windows has no last word on a stream: every
micro-batch brings new versions of the keys it touched.  ``run_to_changelog``
writes these rows to a folder named by the micro-batch, so a batch that is
repeated after a failure overwrites itself.  ``current`` is the latest version of
every key.  ``compact`` writes that table down as of one batch; reading then
takes the newest whole snapshot and only the batches after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session as S
from .runners import BATCH, LateRowsDropped, late_rows, whole_batches


def count_changes(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Each key's count, again whenever it changed (run it in ``update`` mode)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_changes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The first row of each ``cols``; a key's state goes once the watermark has passed its row.

    A key that comes back after that is written again; the table of ``current`` has it once."""
    return df.dropDuplicatesWithinWatermark(list(cols))


def run_to_changelog(changes: DataFrame, name: str, output_mode: str = "update", path: str | None = None,
                     fail_on_late: bool = True) -> str:
    """Run a stream of changes to its end; returns the folder of the changelog.

    With ``path`` a later run goes on where the last one ended."""
    spark = changes.sparkSession
    out = path or S.scratch_path(spark, name)

    def handle(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/changes/{BATCH}={epoch}")

    writer = (changes.writeStream.outputMode(output_mode).foreachBatch(handle)
              .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True))
    late = late_rows(spark, writer)
    if fail_on_late and late:
        raise LateRowsDropped(f"{name}: {late} rows came later than the watermark delay; "
                              "raise the delay or the rate limit, or order the files by time")
    return out


def changelog(spark: SparkSession, out: str) -> DataFrame:
    """All versions, with the micro-batch that wrote them as ``batch``."""
    return spark.read.option("basePath", f"{out}/changes").parquet(f"{out}/changes")


def current(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """The latest version of every key: the newest snapshot and the batches after it."""
    snapshots, batches = whole_batches(spark, f"{out}/snapshot"), whole_batches(spark, f"{out}/changes")
    newest = snapshots[-1] if snapshots else -1
    parts = [f"{out}/changes/{BATCH}={n}" for n in batches if n > newest]
    rows = spark.read.option("basePath", f"{out}/changes").parquet(*parts) if parts else None
    if snapshots:
        kept = spark.read.option("basePath", f"{out}/snapshot").parquet(f"{out}/snapshot/{BATCH}={newest}")
        rows = kept if rows is None else rows.unionByName(kept)
    if rows is None:
        raise ValueError(f"no batch has been written to {out}")
    rest = [c for c in rows.columns if c not in (*keys, BATCH)]
    # one version of a key in a batch; the aggregate combines before the shuffle
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(F.lit(True).alias("_"), *rest), BATCH).alias("_row"))
    return latest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def compact(spark: SparkSession, out: str, keys: Sequence[str]) -> int | None:
    """Write the table as of the newest batch as a snapshot; returns the batch's number (None: nothing to do).

    Call it between runs.  A snapshot cut short has no success mark and is not read."""
    batches, snapshots = whole_batches(spark, f"{out}/changes"), whole_batches(spark, f"{out}/snapshot")
    if not batches or (snapshots and snapshots[-1] >= batches[-1]):
        return None
    current(spark, out, keys).write.mode("overwrite").parquet(f"{out}/snapshot/{BATCH}={batches[-1]}")
    return batches[-1]


__all__ = ["count_changes", "distinct_changes", "run_to_changelog", "changelog", "current", "compact"]
