"""Per-record results in event order on a stream, without Python state.

A stream brings rows in any order within the watermark delay.  ``hold`` keeps
them in short time windows until the watermark has passed a window's end, and
releases the window then: rows of later micro-batches never stand before rows
already released.  A window's rows are dealt into buckets, so a hot key's rows
are spread over the state like any others.

``run_in_order`` hands each released batch to steps that work on it as on a
table (chunked scans, window functions, aggregates) together with what the step
carried over from the batches before: running totals, the last city, counts of
windows still open.  Batch, results and carry are written in folders named by
the micro-batch, so a batch that is repeated after a failure overwrites itself
and starts from the same carry.

A feed that has ended is finished: the rows that the watermark has not passed,
and then those without an event time, go through the steps as last batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session as S
from ..operators.ordered import change_counts, running_totals
from ..operators.windows import first_by
from .runners import LateRowsDropped, late_rows, read_back

RELEASE = "10 minutes"
UNTIL = "_until"

# (rows, what was carried, the time up to which rows are released) -> (results, what to carry)
Step = Callable[[DataFrame, DataFrame | None, Column], tuple[DataFrame, DataFrame]]


def hold(df: DataFrame, time_col: str, order: Sequence[str], width: str = RELEASE) -> DataFrame:
    """The rows of ``df`` once the watermark has passed their window of ``width``, with its end as ``_until``.

    ``df`` needs a watermark on ``time_col``.  Rows of windows still open when a
    run ends stay in the state and come with a later run."""
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = df.groupBy(F.window(time_col, width).alias("_w"), F.pmod(F.xxhash64(*order), F.lit(buckets)).alias("_bucket")).agg(
        F.collect_list(F.struct(*[F.col(c) for c in df.columns])).alias("_rows"))
    return held.select(F.col("_w.end").alias(UNTIL), F.explode("_rows").alias("_r")).select(
        *[F.col(f"_r.{c}").alias(c) for c in df.columns], UNTIL)


def _latest(spark: SparkSession, folder: str, before: int) -> str | None:
    """The newest ``batch=N`` folder with N below ``before``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    numbers = [int(n[6:]) for n in names if n.startswith("batch=") and int(n[6:]) < before]
    return f"{folder}/batch={max(numbers)}" if numbers else None


def _run_steps(session: SparkSession, out: str, steps: dict[str, Step], rows: DataFrame, epoch: int, until: Column) -> None:
    for step_name, step in steps.items():
        before = _latest(session, f"{out}/{step_name}-carry", epoch)
        results, carry = step(rows, session.read.parquet(before) if before else None, until)
        results.write.mode("overwrite").parquet(f"{out}/{step_name}/batch={epoch}")
        carry.write.mode("overwrite").parquet(f"{out}/{step_name}-carry/batch={epoch}")


def _finish(feed: DataFrame, time_col: str, delay: str, out: str, steps: dict[str, Step]) -> None:
    """The rows of an ended feed that the stream has not released: by time, then those without a time.

    Released are all rows before the end of the last window released.  Windows of
    the steps close up to the last watermark, as they do on the stream."""
    spark = feed.sparkSession
    newest = _latest(spark, f"{out}/rows", 1 << 62)
    epoch = int(newest.rsplit("=", 1)[1]) + 1 if newest else 0
    micros = F.unix_micros(time_col)
    done = read_back(spark, f"{out}/rows").agg(F.max(F.unix_micros(UNTIL))).first()[0] if newest else None
    last = feed.agg(F.max(micros)).first()[0]
    until = F.timestamp_micros(F.lit(last).cast("bigint")) - F.expr(f"INTERVAL {delay}")
    timed = F.col(time_col).isNotNull()
    if done is not None:
        timed = F.col(time_col) >= F.timestamp_micros(F.lit(done).cast("bigint"))
    for part in (feed.where(timed), feed.where(F.col(time_col).isNull())):
        rows_at = f"{out}/rows/batch={epoch}"
        rows = part.withColumn(UNTIL, F.lit(None).cast("timestamp"))
        rows.write.mode("overwrite").parquet(rows_at)
        rows = spark.read.schema(rows.schema).parquet(rows_at)
        if not rows.isEmpty():
            _run_steps(spark, out, steps, rows, epoch, until)
        epoch += 1


def run_in_order(released: DataFrame, name: str, steps: dict[str, Step], path: str | None = None,
                 fail_on_late: bool = True, feed: DataFrame | None = None, time_col: str | None = None,
                 delay: str | None = None) -> dict[str, DataFrame]:
    """Run every step over the released batches; returns each step's results so far as a table.

    With ``path`` a later run goes on where the last one ended.  With ``feed``,
    the held stream's rows as a table, the feed has ended: the rows still held
    (``delay`` is the watermark's on ``time_col``) and those without a time are
    brought to the steps too, and no later run may follow."""
    spark = released.sparkSession
    out = path or S.scratch_path(spark, name)

    def handle(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        rows_at = f"{out}/rows/batch={epoch}"
        batch.write.mode("overwrite").parquet(rows_at)
        rows = session.read.schema(batch.schema).parquet(rows_at)
        until = rows.agg(F.max(UNTIL)).first()[0]
        if until is not None:  # else nothing was released
            _run_steps(session, out, steps, rows, epoch, F.lit(until))

    writer = (released.writeStream.outputMode("append").foreachBatch(handle)
             .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True))
    late = late_rows(spark, writer)
    if fail_on_late and late:
        raise LateRowsDropped(f"{name}: {late} rows came later than the watermark delay; "
                              "raise the delay or the rate limit, or order the files by time")
    if feed is not None:
        _finish(feed, time_col, delay, out, steps)
    tables = {}
    for step_name, step in steps.items():
        if _latest(spark, f"{out}/{step_name}", 1 << 62):
            tables[step_name] = read_back(spark, f"{out}/{step_name}").drop("batch")
        else:  # nothing was released
            empty = spark.createDataFrame([], released.schema)
            tables[step_name] = step(empty, None, F.lit(None).cast("timestamp"))[0]
    return tables


def _join_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with its key's carried columns; null keys meet."""
    named = carry.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in carry.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(named, cond, "left").drop(*[f"_k_{k}" for k in keys])


def rolling_step(keys: Sequence[str], order: Sequence[str], value: str) -> Step:
    """Every row with its key's running count and sum of ``value`` (nulls add nothing); carried: the totals."""
    def step(rows: DataFrame, carry: DataFrame | None, until: Column) -> tuple[DataFrame, DataFrame]:
        rows = rows.select(*dict.fromkeys([*keys, *order]), F.coalesce(value, F.lit(0)).alias("_v"))
        rolled = running_totals(rows, keys, order, sums={"running_sum": F.col("_v")}, count_name="running_count").drop("_v")
        totals = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_total"))
        if carry is not None:
            rolled = (_join_carry(rolled, carry, keys)
                      .withColumn("running_count", F.col("running_count") + F.coalesce("_n", F.lit(0)))
                      .withColumn("running_sum", F.col("running_sum") + F.coalesce("_total", F.lit(0))).drop("_n", "_total"))
            totals = totals.unionByName(carry).groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum("_total").alias("_total"))
        return rolled, totals
    return step


def city_step(key: str, time_col: str, size: str, city: str, order: Sequence[str], keep: Sequence[str],
              min_changes: int = 2) -> Step:
    """Rows from the ``min_changes``-th city change of a key's window on, with ``window_start`` and ``n_changes``.

    Rows without a time make a window of their own, without a start.  Carried: last city and changes
    of the windows still open."""
    def step(rows: DataFrame, carry: DataFrame | None, until: Column) -> tuple[DataFrame, DataFrame]:
        timed = F.col(time_col).isNotNull()
        w = F.window(F.coalesce(F.col(time_col), F.timestamp_seconds(F.lit(0))), size)  # a null would lose its row
        names = list(dict.fromkeys([key, *keep, *order]))
        value = F.nullif(F.lower(F.col("_city")), F.lit(""))
        rows = rows.select(F.when(timed, w.start).alias("window_start"), F.when(timed, w.end).alias("_end"), F.col(city).alias("_city"),
                           *names, F.lit(1).alias("_later"))
        if carry is not None:  # a window's last city goes before its new rows
            past = carry.select("window_start", "_end", F.col("_last").alias("_city"), key, F.lit(0).alias("_later"))
            rows = rows.unionByName(past, allowMissingColumns=True)
        group = [key, "window_start"]
        counted = change_counts(rows, group, ["_later", *order], value)
        if carry is not None:
            counted = (_join_carry(counted, carry.select(*group, F.col("_changes").alias("_before")), group)
                       .withColumn("n_changes", F.col("n_changes") + F.coalesce("_before", F.lit(0))))
        place = F.when(value.isNotNull(), F.struct("_later", *order))
        after = (counted.where(F.col("_end") > until).groupBy(*group, "_end")
                 .agg(F.max_by(value, place).alias("_last"), F.max("n_changes").alias("_changes")))
        alerts = counted.where((F.col("_later") == 1) & (F.col("n_changes") >= min_changes))
        return alerts.select(*names, "window_start", "n_changes"), after
    return step


def activity_step(key: str, time_col: str, size: str, order: Sequence[str], keep: Sequence[str], threshold: int) -> Step:
    """Windows of a key with more than ``threshold`` rows, once they are closed: the first row, ``window_start`` and ``n``.

    A window is closed when rows past its end are released.  Carried: count and first row of the windows still open."""
    rest = [c for c in keep if c != key]

    def step(rows: DataFrame, carry: DataFrame | None, until: Column) -> tuple[DataFrame, DataFrame]:
        w = F.window(time_col, size)
        found = (rows.groupBy(F.col(key), w.alias("_w"))
                 .agg(F.count(F.lit(1)).alias("n"), first_by(rest, order).alias("_first"))
                 .select(key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("_end"), "n", "_first"))
        if carry is not None:  # rows carried came before all that are new
            found = (found.withColumn("_later", F.lit(1)).unionByName(carry.withColumn("_later", F.lit(0)))
                     .groupBy(key, "window_start", "_end")
                     .agg(F.sum("n").alias("n"), F.min_by("_first", "_later").alias("_first")))
        closed = found.where((F.col("_end") <= until) & (F.col("n") > threshold))
        return (closed.select(key, *[F.col(f"_first.{c}").alias(c) for c in rest], "window_start", "n"),
                found.where(F.col("_end") > until))
    return step


def member_step(key: str, order: Sequence[str], update: str, keep: Sequence[str], members: DataFrame | None = None,
                member_key: str | None = None) -> Step:
    """Rows whose key is a member at their place in the order; the list is changed by rows of the same stream.

    A row with ``update`` true puts its key on the list and one with false takes it
    off, from the next row on; the last update wins.  Rows without ``update`` are checked.  A
    key without any update so far is a member if the table ``members`` has it; the table
    is read again for every batch.  Carried: the last update of every key that had one, so the carry
    grows with the updated keys, not with the table.  A null key is never a member."""
    names = list(dict.fromkeys([key, *keep, *order]))

    def step(rows: DataFrame, carry: DataFrame | None, until: Column) -> tuple[DataFrame, DataFrame]:
        rows = rows.where(F.col(key).isNotNull()).select(*names, F.col(update).alias("_update"))
        # the previous non-null update of the key, hot keys split along the order
        found = change_counts(rows, [key], order, F.col("_update"), prev_name="_on").where(F.col("_update").isNull())
        on = [F.col("_on")]
        if carry is not None:
            found = _join_carry(found, carry, [key])
            on.append(F.col("_member"))
        if members is not None:
            listed = members.select(F.col(member_key).alias("_listed")).where(F.col("_listed").isNotNull()).dropDuplicates()
            found = found.join(listed, F.col(key) == F.col("_listed"), "left")
            on.append(F.col("_listed").isNotNull())
        last = (rows.where(F.col("_update").isNotNull()).groupBy(key)
                .agg(F.max_by("_update", F.struct(*order)).alias("_member")))
        if carry is not None:
            last = (last.withColumn("_later", F.lit(1)).unionByName(carry.withColumn("_later", F.lit(0)))
                    .groupBy(key).agg(F.max_by("_member", "_later").alias("_member")))
        return found.where(F.coalesce(*on, F.lit(False))).select(*names), last
    return step


__all__ = ["hold", "run_in_order", "rolling_step", "city_step", "activity_step", "member_step", "RELEASE", "UNTIL"]
