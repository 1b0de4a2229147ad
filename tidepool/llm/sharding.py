"""A uniform shuffle into shards of exact sizes by a hypergeometric matrix.

Rows lie in P virtual partitions (by hash of their key).  Which rows of a
uniform shuffle land in which shard is drawn in two steps that together are
exactly uniform: first the P x shards matrix of counts, whose rows follow the
multivariate hypergeometric law given the partition sizes and the exact shard
sizes; then, inside each partition, a random permutation of its rows is cut at
the matrix's running counts.  After the exchange the rows of a shard are
permuted again: a random 64-bit draw orders them, and a row's slot is its rank.

Scale: only counts reach the driver (P is at most ``MAX_PARTS``, so the
matrix has a fixed bound); permutations are windows over (partition) and over
(shard, range of draws) with bounded groups, and rows travel without texts.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, numbered_copies, row_key, unused

SHARDS = 24
SEED = 91
PART_ROWS = 1 << 12
MAX_PARTS = 8192
RANGE_ROWS = 1 << 12


def communication_matrix(part_sizes: list[int], shard_sizes: list[int], seed: int) -> np.ndarray:
    """Counts per (partition, shard): rows sum to the partition sizes, columns to the shard sizes."""
    rng = np.random.default_rng(seed)
    left = np.array(shard_sizes, dtype=np.int64)
    out = np.zeros((len(part_sizes), len(shard_sizes)), np.int64)
    for p, size in enumerate(part_sizes):
        total = int(left.sum())
        for s in range(len(left)):  # one shard at a time, against all later ones
            rest = total - int(left[s])
            take = _hypergeometric(rng, int(left[s]), rest, size)
            out[p, s] = take
            size -= take
            total = rest
        left -= out[p]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good balls among ``draws`` from an urn, for urns of any size."""
    if not draws or not good:
        return 0
    if not bad:
        return draws
    if good + bad < 10**9:  # numpy's limit
        return int(rng.hypergeometric(good, bad, draws))
    # invert the distribution over twelve standard deviations around its mean
    n = good + bad
    mean = draws * (good / n)
    sd = math.sqrt(mean * (bad / n) * max(1, n - draws) / (n - 1)) + 1
    first = max(0, draws - bad, int(mean - 12 * sd))
    last = min(good, draws, int(mean + 12 * sd) + 1)
    k = np.arange(first, last, dtype=np.float64)
    log_p = np.concatenate([[0.0], np.cumsum(np.log((good - k) * (draws - k) / ((k + 1) * (bad - draws + k + 1))))])
    p = np.exp(log_p - log_p.max())
    return first + int(rng.choice(len(p), p=p / p.sum()))


def assign_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                  seed: int = SEED) -> DataFrame:
    """One row per input row: the id, ``key``, ``key2``, ``copy`` (its number among rows equal in id
    and text), ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``shard`` and ``slot``.

    Shard counts differ by at most one, the lower shards are the larger ones;
    slots run without gaps from 0 in every shard.  A null text has no bytes
    and the CRC of no bytes, 0.  Null ids and repeated rows are rows like any
    other.  The result depends on the rows and the seed alone.
    """
    spark = docs.sparkSession
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), k1.alias("key"), k2.alias("key2"),
                       (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
    slim = materialize(numbered_copies(materialize(slim, "shard-sizes"), ["key", "key2"], "copy"), "shard-rows")
    n = slim.count()
    parts = min(MAX_PARTS, max(1, -(-n // PART_ROWS)))

    def draw(step: int):
        return F.xxhash64(F.lit(seed), F.lit(step), "key", "key2", "copy")

    dealt = slim.withColumns({"part": F.pmod(draw(0), F.lit(parts)).cast("int"), "first": draw(1), "second": draw(2)})
    sizes = {r["part"]: r["n"] for r in dealt.groupBy("part").agg(F.count("*").alias("n")).collect()}
    shard_sizes = [n // shards + (s < n % shards) for s in range(shards)]
    matrix = communication_matrix([sizes.get(p, 0) for p in range(parts)], shard_sizes, seed)
    cuts = spark.createDataFrame([(p, row) for p, row in enumerate(matrix.cumsum(axis=1).tolist())],
                                 "part int, cuts array<bigint>")  # at most MAX_PARTS rows

    local = F.row_number().over(Window.partitionBy("part").orderBy("first", "key", "key2", "copy"))
    sent = (dealt.withColumn("local", local).join(F.broadcast(cuts), "part")
            .withColumn("shard", F.size(F.filter("cuts", lambda c: c < F.col("local"))).cast("int")))
    bits = max(0, math.ceil(math.log2(max(1, shard_sizes[0]) / RANGE_ROWS)))
    sent = sent.withColumn("range", F.shiftrightunsigned("second", 64 - bits) if bits else F.lit(0).cast("long"))
    sent = materialize(sent.select("id", "key", "key2", "copy", "size", "text_crc32", "shard", "range", "second"), "shard-sent")

    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sent.groupBy("shard", "range").agg(F.count("*").alias("n"))
               .select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    rank = F.row_number().over(Window.partitionBy("shard", "range").orderBy("second", "key", "key2", "copy"))
    return (sent.withColumn("rank", rank).join(offsets, ["shard", "range"])
            .select(F.col("id").alias(id_col), "key", "key2", "copy", "size", "text_crc32", "shard",
                    (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot")))


def shuffle_into_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                        seed: int = SEED) -> DataFrame:
    """The rows themselves with ``shard`` and ``slot`` (columns of these names are replaced)."""
    key, key2, copy, shard, slot = (unused(docs, c) for c in ("key", "key2", "copy", "shard", "slot"))
    places = materialize(assign_shards(docs, id_col, text_col, shards, seed), "shard-places").select(
        *[F.col(c).alias(n) for c, n in (("key", key), ("key2", key2), ("copy", copy), ("shard", shard), ("slot", slot))])
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    return (numbered_copies(docs.withColumns({key: k1, key2: k2}), [key, key2], copy, counted=places)
            .join(places, [key, key2, copy])
            .select(*keep, F.col(shard).alias("shard"), F.col(slot).alias("slot")))
