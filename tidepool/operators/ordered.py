"""Order-dependent scans that never put a whole key on one task.

A running total or a previous-row comparison per key is naturally a window
``partitionBy(key).orderBy(...)``; with few keys (five event types, three
months) or one hot key that puts a third of the data on one task.  Here hot
keys are split along the order axis into ranges ("chunks"):

1. one aggregate pass gives the exact row count and, from a 1% Bernoulli
   sample, the most frequent keys (``approx_top_k`` over a 64-bit hash of the
   key, at most ``2P`` items, ``P`` = shuffle partitions);
2. a key is *heavy* when it holds more than ``1/(2P)`` of the rows, so at
   most ``2P`` keys qualify; when none does, the plain window is used;
3. every heavy key gets boundaries of its own: a second sample of the heavy
   keys' rows, about ``PER_CHUNK`` rows for each chunk-to-be (so its size
   follows ``P``, not the data), is sorted per key and cut into equal parts of
   about ``total/n`` rows, ``n = 2P``: one shuffle partition's worth, however
   hot the key and however bunched in time.  A boundary is a value of the
   whole order (tie-breakers included), so rows that share the first order
   column split too.  All keys together have at most ``n + 2P`` boundaries;
   they are a broadcast table, searched by halving.  Samples only steer
   balance, never results;
4. light keys stay in chunk 0; rows are windowed per ``(key, chunk)``: one
   shuffle;
5. a one-row-per-chunk summary of the heavy keys carries totals and boundary
   values from chunk to chunk and is broadcast back.  Its size is the number
   of chunks, known before the job runs.

(A 64-bit hash collision would only chunk a light key along with a heavy
one; results stay exact.)

The chunk of a row is a pure function of its key, its order values and the
boundaries, which are literals of the plan, so re-running a lost task yields
the same chunks; no lineage-cutting checkpoint is needed.  Chunks follow the
full order, so results equal the single-window plan exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import order_number

CHUNK = "_chunk"
HEAVY = "_heavy"
MAX_CARRY_ROWS = 200_000  # rows of the broadcast boundary and carry tables
SAMPLE_FRACTION = 0.01    # rows fed to the top-k sketch
MIN_SAMPLE = 20_000       # below this many sampled rows, sketch every row
PER_CHUNK = 128           # sampled rows behind one boundary


@dataclass(frozen=True)
class ChunkPlan:
    total: int
    n_chunks: int   # chunks that the whole table would be cut into
    bounds: dict    # key hash of a heavy key -> its boundaries, ascending rows of order values
    keyed: bool

    @property
    def splits(self) -> bool:
        return any(self.bounds.values())

    @property
    def summary_bound(self) -> int:
        """Most (key, chunk) pairs the carry table can hold."""
        return sum(len(b) + 1 for b in self.bounds.values())


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))


def default_chunks(df: DataFrame) -> int:
    return max(8, 2 * _partitions(df))


def max_heavy_keys(df: DataFrame, keys: Sequence[str]) -> int:
    return 2 * _partitions(df) if keys else 1


def key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of a (possibly multi-column, possibly null) key; 0 without keys."""
    return F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("long")


def order_values(df: DataFrame, order: Sequence[str]) -> Column:
    """The row's place in the order as one struct that sorts like the window (nulls first).

    Dates and times are numbers in it, so boundaries pass through the driver
    whatever the session zone."""
    return F.struct(*[order_number(c, df.schema[c].dataType.simpleString()).alias(f"o{i}") for i, c in enumerate(order)])


def _heavy_keys(df: DataFrame, keys: Sequence[str]) -> tuple[int, list[int]]:
    """Exact row count, and hashes of the keys that hold more than 1/(2P) of the rows."""
    k, frac = max_heavy_keys(df, keys), SAMPLE_FRACTION
    while True:
        pick = F.rand(17) < F.lit(frac) if frac < 1 else F.lit(True)
        picked = df.select(F.when(pick, key_hash(keys)).alias("_h"))  # the random pick lives in a projection
        row = picked.agg(F.count(F.lit(1)).alias("n"), F.count("_h").alias("m"),
                         F.call_function("approx_top_k", F.col("_h"), F.lit(k), F.lit(max(10_000, 4 * k))).alias("top")).first()
        if row["m"] >= MIN_SAMPLE or row["m"] == row["n"]:
            break
        frac = 1.0  # too few rows for a sample
    least = row["m"] / (2 * _partitions(df))
    return row["n"], [t["item"] for t in row["top"] or [] if t["item"] is not None and t["count"] > least]


def plan_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], n_chunks: int | None = None) -> ChunkPlan:
    """Row count, and the heavy keys with their boundaries along ``order``."""
    n = min(max(1, n_chunks or default_chunks(df)), MAX_CARRY_ROWS)
    if n == 1:
        return ChunkPlan(0, 1, {}, bool(keys))
    total, heavy = _heavy_keys(df, keys) if keys else (df.count(), [0])
    if not total or not heavy:
        return ChunkPlan(total, n, {}, bool(keys))
    frac = min(1.0, PER_CHUNK * n / total)
    rows = df.select(key_hash(keys).alias("h"), order_values(df, order).alias("o"))
    if keys:
        rows = rows.where(F.col("h").isin(heavy))
    if frac < 1:
        rows = rows.where(F.rand(23) < F.lit(frac))
    size, per_chunk = F.size("s"), F.lit(max(1.0, total * frac / n))
    parts = F.least(size, F.greatest(F.lit(1), F.ceil(size / per_chunk))).cast("int")
    cut = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.get("s", F.floor(i * size / parts).cast("int")))
    found = (rows.groupBy("h").agg(F.sort_array(F.collect_list("o")).alias("s"))  # PER_CHUNK * n rows in all
             .select("h", F.when(parts > 1, F.array_distinct(cut)).alias("b")).collect())
    return ChunkPlan(total, n, {r["h"]: [tuple(x) for x in r["b"] or []] for r in found}, bool(keys))


def with_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                n_chunks: int | None = None) -> tuple[DataFrame, ChunkPlan]:
    """Add ``_heavy`` (the key is split) and ``_chunk`` (0 for light keys)."""
    plan = plan_chunks(df, keys, order, n_chunks)
    if not plan.splits:
        return df.withColumn(HEAVY, F.lit(False)).withColumn(CHUNK, F.lit(0)), plan
    place = order_values(df, order)
    schema = T.StructType([T.StructField("_heavy_hash", T.LongType()),
                           T.StructField("_bounds", T.ArrayType(df.select(place.alias("o")).schema["o"].dataType))])
    # at most 2P heavy keys with n + 2P boundaries in all: a broadcast hash join
    heavy = df.sparkSession.createDataFrame(list(plan.bounds.items()), schema)
    # without keys a 0 that is not folded away keeps the join an equi-join
    tagged = df.withColumn("_hash", key_hash(keys) if keys else F.monotonically_increasing_id() * 0)
    tagged = tagged.join(F.broadcast(heavy), F.col("_hash") == F.col("_heavy_hash"), "left")
    # boundaries not above the row's place, counted by halving steps
    steps = [1 << i for i in reversed(range(max(map(len, plan.bounds.values())).bit_length()))]
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        F.get("_bounds", at + step - 1) <= place, at + step).otherwise(at))
    tagged = tagged.withColumn(HEAVY, F.col("_bounds").isNotNull())
    return tagged.withColumn(CHUNK, F.when(F.col(HEAVY), below).otherwise(F.lit(0))).drop("_hash", "_heavy_hash", "_bounds"), plan


def _null_safe(left: str, right: str, cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def _order_cols(order: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in order]


def _join_back(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of the (bounded, broadcast) carry table; light keys find none."""
    cond = _null_safe("_r", "_c", [*keys, CHUNK])
    return rows.alias("_r").join(F.broadcast(carried).alias("_c"), cond, "left")


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   sums: Mapping[str, Column] | None = None, count_name: str | None = None,
                   firsts: Sequence[str] = (), n_chunks: int | None = None) -> DataFrame:
    """Every input row plus running aggregates per key in ``order``.

    ``sums``: name -> expression, running ``sum`` up to and including the row
    (SQL semantics: null until the first non-null value).  ``count_name``:
    running row count.  ``firsts``: columns of the key's first row, output as
    ``first_<col>``.  ``order`` must be unique per key for a deterministic
    result (add a tie-breaker column).
    """
    sums = dict(sums or {})
    tagged, plan = with_chunks(df, keys, order, n_chunks)
    part = [*keys, CHUNK]
    w_in = Window.partitionBy(*part).orderBy(*_order_cols(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = [F.sum(e).over(w_in).alias(f"_in_{n}") for n, e in sums.items()]
    if count_name:
        within.append(F.count(F.lit(1)).over(w_in).alias("_in__n"))
    within += [F.first(c).over(w_in).alias(f"_in__f_{c}") for c in firsts]
    rows = tagged.select(*[F.col(c) for c in df.columns], F.col(CHUNK), *within)
    if not plan.splits:  # no hot key: the single window is the whole plan
        return rows.select(*df.columns, *[F.col(f"_in_{n}").alias(n) for n in sums],
                           *([F.col("_in__n").alias(count_name)] if count_name else []),
                           *[F.col(f"_in__f_{c}").alias(f"first_{c}") for c in firsts])

    # heavy keys only: at most plan.summary_bound rows (fixed before the job runs)
    summary_aggs = [F.sum(e).alias(f"_t_{n}") for n, e in sums.items()]
    summary_aggs.append(F.count(F.lit(1)).alias("_t__n"))
    if firsts:
        summary_aggs.append(F.min_by(F.struct(*[F.col(c) for c in firsts]),
                                     F.struct(*_order_cols(order))).alias("_t__first"))
    summary = tagged.where(F.col(HEAVY)).groupBy(*part).agg(*summary_aggs)

    w_ck = Window.partitionBy(*keys).orderBy(CHUNK)
    before = w_ck.rowsBetween(Window.unboundedPreceding, -1)
    carried_cols = [F.sum(f"_t_{n}").over(before).alias(f"_o_{n}") for n in sums]
    carried_cols.append(F.coalesce(F.sum("_t__n").over(before), F.lit(0)).alias("_o__n"))
    if firsts:
        whole = w_ck.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        carried_cols.append(F.first("_t__first").over(whole).alias("_o__first"))
    carried = summary.select(*keys, CHUNK, *carried_cols)

    joined = _join_back(rows, carried, keys)
    out = [F.col(f"_r.{c}") for c in df.columns]
    out += [F.coalesce(F.col(f"_c._o_{n}") + F.col(f"_r._in_{n}"), F.col(f"_c._o_{n}"),
                       F.col(f"_r._in_{n}")).alias(n) for n in sums]
    if count_name:
        out.append((F.coalesce(F.col("_c._o__n"), F.lit(0)) + F.col("_r._in__n")).alias(count_name))
    matched = F.col("_c._o__n").isNotNull()
    out += [F.when(matched, F.col(f"_c._o__first.{c}")).otherwise(F.col(f"_r._in__f_{c}"))
            .alias(f"first_{c}") for c in firsts]
    return joined.select(*out)


def change_counts(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
                  prev_name: str = "prev_value", count_name: str = "n_changes",
                  n_chunks: int | None = None) -> DataFrame:
    """Every row plus the previous non-null ``value`` of its key and the running
    number of changes (a row whose value differs from the previous non-null
    value).  Rows whose value is null neither change nor reset anything.
    """
    tagged, plan = with_chunks(df.withColumn("_v", value), keys, order, n_chunks)
    part = [*keys, CHUNK]
    w = Window.partitionBy(*part).orderBy(*_order_cols(order))
    upto_prev = w.rowsBetween(Window.unboundedPreceding, -1)
    upto_cur = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step1 = tagged.withColumn("_prev_in", F.last("_v", ignorenulls=True).over(upto_prev)).withColumn(
        "_flag_in", (F.col("_v").isNotNull() & F.col("_prev_in").isNotNull()
                     & (F.col("_v") != F.col("_prev_in"))).cast("int"))
    rows = step1.withColumn("_run_in", F.sum("_flag_in").over(upto_cur))
    if not plan.splits:  # no hot key: the single window is the whole plan
        return rows.select(*df.columns, F.col("_prev_in").alias(prev_name),
                           F.coalesce(F.col("_run_in"), F.lit(0)).cast("bigint").alias(count_name))

    present = F.when(F.col("_v").isNotNull(), F.struct(*_order_cols(order)))
    summary = step1.where(F.col(HEAVY)).groupBy(*part).agg(
        F.min_by("_v", present).alias("_first_v"),
        F.max_by("_v", present).alias("_last_v"),
        F.sum("_flag_in").alias("_changes_in"))
    w_ck = Window.partitionBy(*keys).orderBy(CHUNK)
    before = w_ck.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.withColumn("_carry", F.last("_last_v", ignorenulls=True).over(before))
    carry = carry.withColumn("_edge", (F.col("_first_v").isNotNull() & F.col("_carry").isNotNull()
                                       & (F.col("_first_v") != F.col("_carry"))).cast("int"))
    carry = carry.withColumn("_offset", F.coalesce(
        F.sum(F.col("_changes_in") + F.col("_edge")).over(before), F.lit(0)))
    carried = carry.select(*keys, CHUNK, "_carry", "_edge", "_offset")

    joined = _join_back(rows, carried, keys)
    # Only the chunk's first non-null row is compared with the carry; every
    # later row already has a non-null previous value inside the chunk.
    seen_first = F.col("_r._prev_in").isNotNull() | F.col("_r._v").isNotNull()
    edge = F.when(seen_first, F.coalesce(F.col("_c._edge"), F.lit(0))).otherwise(0)
    n_changes = F.coalesce(F.col("_c._offset"), F.lit(0)) + edge + F.col("_r._run_in")
    return joined.select(*[F.col(f"_r.{c}") for c in df.columns],
                         F.coalesce(F.col("_r._prev_in"), F.col("_c._carry")).alias(prev_name),
                         n_changes.cast("bigint").alias(count_name))


__all__ = ["ChunkPlan", "plan_chunks", "with_chunks", "order_values", "running_totals", "change_counts",
           "default_chunks", "max_heavy_keys", "key_hash", "CHUNK", "HEAVY", "PER_CHUNK", "SAMPLE_FRACTION", "MIN_SAMPLE"]
