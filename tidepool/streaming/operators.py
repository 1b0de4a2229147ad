"""Streaming forms of the order-dependent operators.

Spark rejects ``lag`` and row frames on streams, so the per-record rolling
reduce and the per-window city-change rule keep their own state:

* rolling reduce: ``applyInPandasWithState`` keyed by the series key, state =
  (count, sum, last order value); one output row per input row in the
  explicit order.
* city changes: keyed by (customer, window); state = (last city, changes,
  last order value);
  an event-time timeout drops the state once the watermark passes the
  window end, so state does not grow with time.

Both sort within a micro-batch and fail with ``LateRowsDropped`` where a later
micro-batch brings a row of the key that stands before one already written.

Window aggregations (tumbling, sliding, session, global) and membership
rules need no extra code: the batch operators accept streaming frames.  A
stream-static join lists the static side's files once, at the start; lists
that change while a query runs go through :func:`flag_members_refreshed`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from .. import session as S
from ..operators import rules, windows
from .runners import read_back, run_foreach_batch
from .stateful import in_order, rolling_state_fn


def _spark_type(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def stream_rolling(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                   sum_type: str = "bigint", strict: bool = True) -> DataFrame:
    """Per-record running count and sum of ``value`` per key (update per row).

    With ``strict`` off, rows of a later micro-batch count after those of
    earlier ones whatever their order: only for rows that are interchangeable."""
    cols = [*keys, *order]
    schema = ", ".join(f"{c} {_spark_type(df, c)}" for c in cols)
    schema += f", running_count bigint, running_sum {sum_type}"
    state = f"n bigint, total {sum_type}, last binary"
    return df.select(*cols, value).groupBy(*keys).applyInPandasWithState(
        rolling_state_fn(list(keys), list(order), value, strict), schema, state, "append",
        GroupStateTimeout.NoTimeout)


def _city_change_fn(order_cols, out_cols, min_changes):
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        last, n, place = state.get if state.exists else (None, 0, None)
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(order_cols)
        place = in_order(pdf, order_cols, place, key)
        rows, counts = [], []
        for i, city in enumerate(pdf["_city"].tolist()):
            city = city.lower() if isinstance(city, str) and city else None
            if city is not None:
                if last is not None and city != last:
                    n += 1
                last = city
            if n >= min_changes:
                rows.append(i)
                counts.append(n)
        state.update((last, n, place))
        state.setTimeoutTimestamp(int(key[-1]))
        if rows:
            out = pdf.iloc[rows][out_cols].copy()
            out["n_changes"] = counts
            yield out
    return fn


def stream_city_changes(df: DataFrame, key: str, time_col: str, size: str, city: str,
                        order: Sequence[str], keep: Sequence[str], min_changes: int = 2) -> DataFrame:
    """Rows from the ``min_changes``-th city change on, per key and tumbling
    window (input needs a watermark on ``time_col``).  Rows of one key and window
    have to reach the micro-batches in ``order``, or the run fails.  The state's timeout is
    the window end as epoch milliseconds computed by Spark, so it does not
    depend on the session's or the workers' time zone."""
    w = F.window(time_col, size)
    keyed = df.withColumn("_wstart", w.start) \
        .withColumn("_wend_ms", F.unix_millis(w.end)).withColumn("_city", F.col(city))
    out_cols = list(dict.fromkeys([key, "_wstart", *keep, *order]))
    schema = ", ".join(f"{c} {_spark_type(keyed, c)}" for c in out_cols) + ", n_changes bigint"
    fn = _city_change_fn(list(order), out_cols, min_changes)
    # the watermark travels with the time column
    return keyed.select(*dict.fromkeys([*out_cols, time_col, "_wend_ms", "_city"])) \
        .groupBy(key, "_wend_ms").applyInPandasWithState(
            fn, schema, "last string, n bigint, place binary", "append", GroupStateTimeout.EventTimeTimeout) \
        .withColumnRenamed("_wstart", "window_start")


def flag_members_refreshed(txns: DataFrame, load_checks: Callable[[SparkSession], Sequence[tuple]],
                           txn_cols: Sequence[str]) -> DataFrame:
    """Membership rules over a stream whose lists may change while it runs.

    ``load_checks(spark)`` gives the (key column, members, member key, rule)
    checks and is called for every micro-batch, so a list is read again, and
    its join planned by its size then, each time.  Each micro-batch's alerts
    are written to a folder of its own (a repeated batch overwrites itself);
    returns the alerts of all of them.
    """
    out = S.scratch_path(txns.sparkSession, "members")
    schema = []

    def handle(batch: DataFrame, epoch: int) -> None:
        alerts = rules.flag_members_many(batch, load_checks(batch.sparkSession), txn_cols)
        schema[:] = [alerts.schema]
        alerts.write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    run_foreach_batch(txns, "members-run", handle)
    if not schema:  # nothing arrived
        spark = txns.sparkSession
        return rules.flag_members_many(spark.createDataFrame([], txns.schema), load_checks(spark), txn_cols)
    return read_back(txns.sparkSession, out).select(*schema[0].fieldNames())


def processing_time_window(df: DataFrame, size: str, keys: Sequence[str],
                           aggs: Mapping[str, Column], lateness: str = "0 seconds",
                           heartbeat: bool = False) -> DataFrame:
    """Tumbling window on arrival (processing) time: the clock of the
    micro-batch stamps each row; results are not reproducible run to run.

    A window closes with the first micro-batch that has rows after its end.  With
    ``heartbeat`` a row a second of a clock stream moves the time on while no
    row arrives, so windows close by themselves; heartbeats are a group of their own in
    every window and never come out or count."""
    if heartbeat:
        clock = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
        beats = clock.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields],
                             F.lit(True).alias("_beat"))
        df = df.withColumn("_beat", F.lit(False)).unionByName(beats)
    stamped = df.withColumn("_proc_time", F.current_timestamp()) \
        .withWatermark("_proc_time", lateness)
    if not heartbeat:
        return windows.tumbling(stamped, "_proc_time", size, keys, aggs)
    # an aggregate decides, so that the filter stays above the watermark
    found = windows.tumbling(stamped, "_proc_time", size, [*keys, "_beat"], {**aggs, "_beats": F.max("_beat")})
    return found.where(~F.col("_beats")).drop("_beat", "_beats")


__all__ = ["stream_rolling", "stream_city_changes", "flag_members_refreshed", "processing_time_window"]
