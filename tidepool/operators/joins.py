"""Join helpers: broadcasts left to statistics or behind a byte check, stream/table equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes we are willing to ship to every executor.
BROADCAST_MAX_BYTES = 64 << 20
_ROW_OVERHEAD = 32


def fits(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df``'s values and row overhead add up to at most ``max_bytes``.

    One pruned scan that sends one partial sum per task, never rows.
    """
    size = F.lit(_ROW_OVERHEAD)
    for c in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return (df.agg(F.sum(size.cast("bigint"))).first()[0] or 0) <= max_bytes


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint when the side is proven small; otherwise unchanged, so the
    join falls back to a shuffle join (which AQE may still turn into a
    broadcast at runtime once it has measured the shuffled size)."""
    return F.broadcast(df) if fits(df, max_bytes) else df


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def semi_join(df: DataFrame, key_col: str, members: DataFrame, member_key: str) -> DataFrame:
    """Rows of ``df`` whose ``key_col`` appears in ``members``; each row at most once.

    No hint: Spark broadcasts the list's keys if its statistics (or AQE's
    measured size) are below the session's threshold, and shuffles otherwise.
    """
    keys = members.select(F.col(member_key).alias("_member"))
    return df.join(keys, F.col(key_col) == F.col("_member"), "left_semi")


def equi_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "inner",
              left_time: str | None = None, right_time: str | None = None,
              watermark: str | None = None, within: str | None = None) -> DataFrame:
    """Inner equi-join keeping every match (tables or two streams).

    For two unbounded streams pass ``left_time``, ``right_time``, ``watermark``
    and ``within``, all four, so Spark can expire join state: rows match only
    when their times are at most ``within`` apart.  Without them the join
    state grows without bound, exactly as the unbounded regular join it
    reproduces.  The key columns appear once, the left side's first; other
    column names must differ between the sides.
    """
    on = [on] if isinstance(on, str) else list(on)
    bounds = [left_time, right_time, watermark, within]
    if not any(bounds):
        return left.join(right, on, how)
    if not all(bounds):
        raise ValueError("a time-bounded join needs left_time, right_time, watermark and within")
    l = left.withWatermark(left_time, watermark).alias("l")
    r = right.withWatermark(right_time, watermark).alias("r")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on]
    cond.append(F.col(f"r.{right_time}").between(
        F.col(f"l.{left_time}") - F.expr(f"interval {within}"),
        F.col(f"l.{left_time}") + F.expr(f"interval {within}")))
    return l.join(r, cond, how).select(*[F.col(f"l.{c}") for c in left.columns],
                                       *[F.col(f"r.{c}") for c in right.columns if c not in on])


def ttl_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, ttl: str) -> DataFrame:
    """Regular inner equi-join of two streams whose rows are remembered for ``ttl`` after they arrive.

    Every pair of rows that arrive at most ``ttl`` apart comes out once, when the later of them
    arrives; arrival is the clock of the micro-batch, so which pairs are that close depends on the run.
    No row is ever late.  A row leaves the state once both sides have moved on by more than
    ``ttl`` (set ``spark.sql.streaming.multipleWatermarkPolicy`` to ``max`` before the first start if one
    side may fall silent).  Expiry looks over the whole state once a micro-batch.  Two tables arrive at
    once: all pairs."""
    arrived = ["_left_arrival", "_right_arrival"]
    left, right = (df.withColumn(name, F.current_timestamp()) for df, name in zip((left, right), arrived))
    return equi_join(left, right, on, left_time=arrived[0], right_time=arrived[1], watermark="0 seconds",
                     within=ttl).drop(*arrived)


__all__ = ["BROADCAST_MAX_BYTES", "fits", "sized_broadcast", "null_safe_on",
           "semi_join", "equi_join", "ttl_join"]
