"""Running and windowed reduces with a merge of the user's own.

A keyed reduce takes any associative ``merge`` of two states, given as a lambda
over columns, and need not be a sum: the merge may depend on the order of its
sides (first city, largest rise so far, joined text).  Window functions can't run such a
merge, and a fold over a key's collected rows would put a hot key into one task.
So rows are folded in a tree of blocks:

1. every row gets its place in its key's order (``running_totals``, which splits
   hot keys along the order);
2. ``BLOCK`` consecutive rows of a key make a block: one bounded array, folded to
   running states by a SQL lambda;
3. the last states of full blocks are the rows of the next level, and so on until no key
   has a full block.  Each level holds 1/``BLOCK`` of the rows below it;
4. on the way down every block but a key's first merges the state before it
   into its own.

The blocks of a hot key spread over all tasks like any others, and no group is
larger than ``BLOCK`` rows.  Everything stays in JVM expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_totals

BLOCK = 64
Merge = Callable[[Column, Column], Column]


def _match(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Left join on ``names`` (nulls meet); the right side's other columns are kept."""
    named = right.select(*[F.col(c).alias(f"_right{i}") for i, c in enumerate(names)],
                         *[c for c in right.columns if c not in names])
    cond = F.lit(True)
    for i, c in enumerate(names):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_right{i}"))
    return left.join(named, cond, "left").drop(*[f"_right{i}" for i in range(len(names))])


def _running(keys: Sequence[str], items: DataFrame, merge: Merge, most: int, block: int) -> DataFrame:
    """``items`` (keys, ``_at`` from 0 without gaps, ``_row``, ``_state``) with the state up to and including each.

    ``most`` is the largest number of items of one key."""
    at = F.col("_at")
    blocks = items.groupBy(*keys, F.floor(at / block).alias("_block")).agg(
        F.sort_array(F.collect_list(F.struct("_at", "_row", "_state"))).alias("_items"))
    # the running states of a block, oldest first
    states = F.aggregate(F.slice("_items", 2, block), F.array(F.col("_items")[0]["_state"]),
                         lambda done, item: F.array_append(done, merge(F.element_at(done, -1), item["_state"])))
    blocks = blocks.select(*keys, "_block", "_items", states.alias("_states"))
    if most > block:
        full = blocks.where(F.size("_items") == block)
        above = _running(keys, full.select(*keys, F.col("_block").alias("_at"), F.lit(None).cast("string").alias("_row"),
                                           F.element_at("_states", -1).alias("_state")), merge, most // block, block)
        before = above.select(*keys, (F.col("_at") + 1).alias("_block"), F.col("_state").alias("_before"))
        blocks = _match(blocks, before, [*keys, "_block"])
        blocks = blocks.withColumn("_states", F.when(F.col("_before").isNull(), F.col("_states")).otherwise(
            F.transform("_states", lambda s: merge(F.col("_before"), s)))).drop("_before")
    pairs = F.explode(F.zip_with("_items", "_states", lambda i, s: F.struct(
        i["_at"].alias("_at"), i["_row"].alias("_row"), s.alias("_state")))).alias("_p")
    return blocks.select(*keys, pairs).select(*keys, "_p._at", "_p._row", "_p._state")


def running_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], state: Column, merge: Merge,
                 name: str = "state", n_chunks: int | None = None, block: int = BLOCK) -> DataFrame:
    """Every row plus its key's reduced state up to and including the row.

    ``state`` is a row's own state, never null (a struct may hold nulls), and ``merge(earlier, later)`` an associative merge
    of two states that gives the same type.  ``order`` has to be unique per key.
    Columns whose names start with an underscore are not expected in ``df``."""
    if block < 2:
        raise ValueError("a block holds at least two rows")
    placed = running_totals(df, keys, order, count_name="_n", n_chunks=n_chunks)
    items = placed.select(*keys, (F.col("_n") - 1).alias("_at"), F.struct(*[F.col(c) for c in df.columns]).alias("_row"),
                          state.alias("_state"))
    most = df.groupBy(*keys).count().agg(F.max("count")).first()[0]  # one number: how many levels there are
    done = _running(keys, items, merge, most or 0, block)
    return done.select(*[F.col(f"_row.{c}").alias(c) for c in df.columns], F.col("_state").alias(name))


def window_fold(df: DataFrame, time_col: str, size: str, keys: Sequence[str], order: Sequence[str], state: Column,
                merge: Merge, name: str = "state", n_chunks: int | None = None, block: int = BLOCK) -> DataFrame:
    """One row per key and tumbling window: ``window_start``, ``window_end`` and the reduced state of its rows."""
    w = F.window(time_col, size)
    rows = df.select("*", w.start.alias("window_start"), w.end.alias("window_end"))
    group = [*keys, "window_start", "window_end"]
    running = running_fold(rows, group, order, state, merge, name, n_chunks, block)
    return running.groupBy(*group).agg(F.max_by(name, F.struct(*order)).alias(name))


__all__ = ["BLOCK", "running_fold", "window_fold"]
