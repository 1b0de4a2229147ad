"""Time-window aggregations: tumbling, sliding, session and global windows.

All of them are ``groupBy(window(...), keys).agg(...)``: Spark plans a
partial aggregate in every map task and a final one after the hash shuffle,
so a hot key is pre-combined before it is shuffled.  Every aggregate used
here (sum, count, min, max, min_by, max_by) is combinable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _flatten(grouped: DataFrame, wcol: str, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return grouped.select(*keys, F.col(f"{wcol}.start").alias("window_start"),
                          F.col(f"{wcol}.end").alias("window_end"), *names)


def _agg_list(aggs: Mapping[str, Column]) -> list[Column]:
    return [expr.alias(name) for name, expr in aggs.items()]


def tumbling(df: DataFrame, time_col: str, size: str, keys: Sequence[str],
             aggs: Mapping[str, Column], start_offset: str | None = None) -> DataFrame:
    """Non-overlapping windows of ``size`` aligned to the epoch (plus offset)."""
    w = F.window(time_col, size, size, start_offset) if start_offset else F.window(time_col, size)
    grouped = df.groupBy(w.alias("_w"), *keys).agg(*_agg_list(aggs))
    return _flatten(grouped, "_w", keys, list(aggs))


def sliding(df: DataFrame, time_col: str, size: str, slide: str, keys: Sequence[str],
            aggs: Mapping[str, Column]) -> DataFrame:
    """Hopping windows: ``size`` long, a new one every ``slide``.

    (The SQL ``HOP(time, slide, size)`` form takes slide first; Spark's
    ``window(time, size, slide)`` takes size first.)  Each row is expanded
    into ``size/slide`` windows before the partial aggregate.
    """
    grouped = df.groupBy(F.window(time_col, size, slide).alias("_w"), *keys).agg(*_agg_list(aggs))
    return _flatten(grouped, "_w", keys, list(aggs))


def sliding_sums(df: DataFrame, time_col: str, size: str, slide: str, keys: Sequence[str],
                 sums: Mapping[str, Column], count_name: str | None = None) -> DataFrame:
    """Hopping windows of sums and a row count, through panes.

    Rows are first added up per slide-wide pane, each once; only the panes
    (one row per key and slide) are then expanded into the windows they belong
    to.  ``size`` must be a multiple of ``slide``.  On a stream (append mode, a watermark on
    ``time_col``) a pane goes on to its windows when it is closed.
    """
    pane_aggs = {n: F.sum(e) for n, e in sums.items()}
    if count_name:
        pane_aggs[count_name] = F.count(F.lit(1))
    if df.isStreaming:  # the pane itself hands the watermark on
        panes = df.groupBy(F.window(time_col, slide).alias("_pane"), *keys).agg(*_agg_list(pane_aggs))
    else:
        panes = tumbling(df, time_col, slide, keys, pane_aggs).drop("window_end").withColumnRenamed("window_start", "_pane")
    return sliding(panes, "_pane", size, slide, keys, {n: F.sum(n) for n in pane_aggs})


def session(df: DataFrame, time_col: str, gap: str, keys: Sequence[str],
            aggs: Mapping[str, Column]) -> DataFrame:
    """Gap-based sessions per key; rows exactly ``gap`` apart share a session.

    Plain form: every row of a key meets in one task (sessions are merged
    after the shuffle).  On streams ``sessionWindow.merge.sessions.in.local.
    partition`` pre-merges per task; for tables use :func:`session_sums`.
    """
    grouped = df.groupBy(F.session_window(time_col, gap).alias("_w"), *keys).agg(*_agg_list(aggs))
    return _flatten(grouped, "_w", keys, list(aggs))


def session_sums(df: DataFrame, time_col: str, gap: str, keys: Sequence[str],
                 sums: Mapping[str, Column], count_name: str | None = None) -> DataFrame:
    """Sessions of sums and a row count on a table, through panes.

    Rows of a key within one gap-wide pane share a session whatever else there
    is, so they are added up first, by a partial aggregate in every map task.
    What is left of a key is one row per pane; sessions are built over these
    with a gap that starts at the pane's last row, so panes join exactly as
    their rows would have.  A hot key thus reaches its task as at most one row per
    gap of the time it covers, however many rows share an instant.
    ``gap`` is a fixed time: no months, and no days on times with a zone.  Rows
    without a time are left out.
    """
    pane_aggs = {"_first": F.min(time_col), "_last": F.max(time_col), **{n: F.sum(e) for n, e in sums.items()}}
    if count_name:
        pane_aggs[count_name] = F.count(F.lit(1))
    panes = tumbling(df, time_col, gap, keys, pane_aggs).drop("window_start", "window_end")
    dtype = df.schema[time_col].dataType.simpleString()
    until = F.col("_last") + F.expr(f"INTERVAL {gap}")
    span = F.concat(_micros_between("_first", until, dtype).cast("string"), F.lit(" microseconds"))
    names = [*sums, *([count_name] if count_name else [])]
    grouped = panes.groupBy(F.session_window("_first", span).alias("_w"), *keys).agg(*[F.sum(n).alias(n) for n in names])
    return _flatten(grouped, "_w", keys, names)


def session_split(df: DataFrame, time_col: str, gap: str, keys: Sequence[str],
                  sums: Mapping[str, Column], count_name: str | None = None,
                  n_chunks: int | None = None) -> DataFrame:
    """Sessions per key whose hot keys are split along time.

    Heavy keys (see :mod:`tidepool.operators.ordered`) get time chunks;
    sessions are built per ``(key, chunk)`` in parallel.  Only a chunk's
    first and last session can continue across a chunk edge, so a second
    session window over the heavy keys' pieces (per-row gap = the piece's
    own length, so touching or overlapping pieces join exactly as their rows
    would have) groups those edge pieces together while every other piece
    stays in its own chunk group and passes through.  Light keys take the
    plain session plan in a separate branch, so their rows are shuffled once
    and never re-merged.  The aggregates must be combinable: ``sums``
    (name -> expression) and a row count.
    """
    from .ordered import CHUNK, HEAVY, with_chunks

    tagged, plan = with_chunks(df, keys, [time_col], n_chunks)
    if not plan.splits:
        aggs = {n: F.sum(e) for n, e in sums.items()}
        if count_name:
            aggs[count_name] = F.count(F.lit(1))
        return session(df, time_col, gap, keys, aggs)

    first_aggs = [F.sum(e).alias(n) for n, e in sums.items()]
    if count_name:
        first_aggs.append(F.count(F.lit(1)).alias(count_name))
    names = [*sums, *([count_name] if count_name else [])]

    # light keys: the plain session plan (each row shuffled once, no re-merge)
    light = tagged.where(~F.col(HEAVY)) \
        .groupBy(*keys, F.session_window(time_col, gap).alias("_w")).agg(*first_aggs) \
        .select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                *names)

    # heavy keys: sessions per (key, chunk) in parallel, then one more session
    # pass over their pieces grouped by (key, grp): interior pieces keep their
    # chunk as grp (they never touch each other, so they pass through and stay
    # spread over the chunks); edge pieces (a chunk's first and last, at most
    # two per chunk) share grp -1 and merge across chunk edges
    pieces = tagged.where(F.col(HEAVY)) \
        .groupBy(*keys, CHUNK, F.session_window(time_col, gap).alias("_w")).agg(*first_aggs) \
        .select(*keys, CHUNK, F.col("_w.start").alias("window_start"),
                F.col("_w.end").alias("window_end"), *names)
    edge = Window.partitionBy(*keys, CHUNK)
    is_edge = (F.col("window_start") == F.min("window_start").over(edge)) \
        | (F.col("window_start") == F.max("window_start").over(edge))
    grp = F.when(is_edge, F.lit(-1)).otherwise(F.col(CHUNK))
    dtype = df.schema[time_col].dataType.simpleString()
    span = F.concat(_micros_between("window_start", "window_end", dtype).cast("string"),
                    F.lit(" microseconds"))
    heavy = pieces.withColumn("_grp", grp) \
        .groupBy(*keys, "_grp", F.session_window("window_start", span).alias("_w")) \
        .agg(*[F.sum(n).alias(n) for n in names]) \
        .select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                *names)
    return light.unionByName(heavy)


def _micros_between(start: str | Column, end: str | Column, dtype: str) -> Column:
    from ..functions.time import order_number

    return order_number(end, dtype) - order_number(start, dtype)


def global_window(df: DataFrame, time_col: str, size: str, aggs: Mapping[str, Column]) -> DataFrame:
    """Non-keyed tumbling window.  Unlike a parallelism-1 window operator, each
    task pre-aggregates and only one row per window and task is shuffled."""
    return tumbling(df, time_col, size, [], aggs)


def first_by(cols: Sequence[str] | str, order: Sequence[str]) -> Column:
    """Value(s) of the earliest row under ``order`` (a unique order gives a
    deterministic pick).  Combinable, so it keeps the partial aggregate."""
    val = F.col(cols) if isinstance(cols, str) else F.struct(*[F.col(c) for c in cols])
    return F.min_by(val, F.struct(*[F.col(c) for c in order]))


def last_by(cols: Sequence[str] | str, order: Sequence[str]) -> Column:
    val = F.col(cols) if isinstance(cols, str) else F.struct(*[F.col(c) for c in cols])
    return F.max_by(val, F.struct(*[F.col(c) for c in order]))


def window_reduce(df: DataFrame, time_col: str, size: str, keys: Sequence[str], sum_col,
                  order: Sequence[str], first_cols: Sequence[str] = (),
                  sum_name: str = "total", count_name: str = "n") -> DataFrame:
    """Keyed window reduce: sum of one field, row count, and the first row's
    other fields (``first_<name>``), emitted once per window."""
    s = F.col(sum_col) if isinstance(sum_col, str) else sum_col
    aggs: dict[str, Column] = {sum_name: F.sum(s), count_name: F.count(F.lit(1))}
    if first_cols:
        aggs["_first"] = first_by(list(first_cols), order)
    out = tumbling(df, time_col, size, keys, aggs)
    if first_cols:
        out = out.select(*[c for c in out.columns if c != "_first"],
                         *[F.col(f"_first.{c}").alias(f"first_{c}") for c in first_cols])
    return out


__all__ = ["tumbling", "sliding", "sliding_sums", "session", "session_sums", "session_split", "global_window", "window_reduce",
           "first_by", "last_by"]
