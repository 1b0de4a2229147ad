"""Change detection between consecutive windows and consecutive events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import change_counts
from .windows import tumbling


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pct_change(cur: Column, prev: Column) -> Column:
    """Percent change against the previous value; 0.0 when there is none or it is 0."""
    return F.when(prev.isNull() | (prev == 0), F.lit(0.0)).otherwise(
        ((cur - prev).cast("double") / prev) * 100.0)


def window_stats(df: DataFrame, time_col: str, size: str, keys: Sequence[str], price,
                 volume, order: Sequence[str]) -> DataFrame:
    """Per (key, window): max/min of price and volume, first and last event time.

    Maxima start from 0 as in the job being reproduced (``greatest(max, 0)``);
    minima are the plain minimum.  The first and last event *times* do not
    depend on the tie-break in ``order``, so they are plain min/max: every
    aggregate has a fixed-width buffer and the plan keeps a hash partial
    aggregate.
    """
    aggs = {
        "max_price": F.greatest(F.max(_c(price)), F.lit(0).cast("double")),
        "min_price": F.min(_c(price)),
        "max_volume": F.greatest(F.max(_c(volume)), F.lit(0)),
        "min_volume": F.min(_c(volume)),
        "first_ts": F.min(time_col),
        "last_ts": F.max(time_col),
    }
    return tumbling(df, time_col, size, keys, aggs)


def window_change(df: DataFrame, time_col: str, size: str, keys: Sequence[str], price,
                  volume, order: Sequence[str]) -> DataFrame:
    """Window report: per-window stats plus the percent change of the maxima
    against the key's previous non-empty window (0.0 for the first).

    The lag runs over the aggregated windows (one row per key and window),
    so its partitions are small whatever the input size.
    """
    stats = window_stats(df, time_col, size, keys, price, volume, order)
    w = Window.partitionBy(*keys).orderBy("window_start")
    return stats.select(
        "*",
        pct_change(F.col("max_price"), F.lag("max_price").over(w)).alias("max_price_change"),
        pct_change(F.col("max_volume"), F.lag("max_volume").over(w)).alias("max_volume_change"))


def large_delta(df: DataFrame, time_col: str, size: str, keys: Sequence[str], price,
                order: Sequence[str], threshold: float = 5.0) -> DataFrame:
    """Alert when the window maximum moved by more than ``threshold`` percent
    (strict) against the key's previous non-empty window.  The first window
    never alerts.  ``max_ts`` is the earliest time the maximum was reached.
    """
    p = _c(price)
    arg_key = F.struct((-p).alias("neg"), *[F.col(c) for c in order])
    per_window = tumbling(df, time_col, size, keys, {
        "cur_max": F.greatest(F.max(p), F.lit(0).cast("double")),
        "max_ts": F.min_by(F.col(time_col), arg_key),
    })
    w = Window.partitionBy(*keys).orderBy("window_start")
    with_prev = per_window.withColumn("prev_max", F.lag("cur_max").over(w))
    change = ((F.col("cur_max") - F.col("prev_max")) / F.col("prev_max")) * 100.0
    return with_prev.where(F.col("prev_max").isNotNull() & (F.col("prev_max") != 0)
                           & (F.abs(change) > F.lit(float(threshold)))) \
        .select(*keys, "window_start", "window_end", "prev_max", "cur_max",
                change.alias("pct_change"), "max_ts")


def frequent_change(df: DataFrame, keys: Sequence[str], order: Sequence[str], city,
                    min_changes: int = 2, n_chunks: int | None = None) -> DataFrame:
    """Rows from the ``min_changes``-th change of ``city`` onwards within each key
    group (e.g. customer x window).  Comparison is case-insensitive; empty
    values are ignored.
    """
    value = F.nullif(F.lower(_c(city)), F.lit(""))
    counted = change_counts(df, keys, order, value, prev_name="prev_city", count_name="n_changes",
                            n_chunks=n_chunks)
    return counted.where(F.col("n_changes") >= min_changes)


__all__ = ["pct_change", "window_stats", "window_change", "large_delta", "frequent_change"]
