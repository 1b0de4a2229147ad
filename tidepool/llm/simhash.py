"""SimHash near-dedup with deletion-variant signatures.

Fingerprints of 64 bits that differ in at most 3 are cut into 2 segments, one
of which then differs in at most one bit.  Each segment is indexed under
variants with one bit wiped out (32 per segment), so two segments at most one
bit apart share a variant; candidates meet by equality of (segment, wiped bit,
what is left) and are verified on all 64 bits.

Copies cost nothing: only distinct fingerprints are indexed.  Pairs within a
dense group are never all made: in every bucket the members are first linked
to one hub (its smallest fingerprint) where they are within the distance;
after the components of those links are known, only buckets that still hold
several components are joined with themselves, and only across components.
There, members of a bucket of more than ``CROWD`` meet only where a byte of
the other segment is equal too: of its four bytes at most three can differ.
No link between components can be missed, since every linked pair shares a
bucket and is either inside one component already or joined here.

Scale: all exchanges carry 16-byte rows; buckets are keyed by 31 bits of
fingerprint and shuffled once (of a dense group each of its 64 variants has its
own; buckets with more than a task's share of all fingerprints get their hub
from a pre-aggregated table and stay where they are), the joins are plain equi-joins that the skew join can split, and components are found by rounds of joins over written tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, row_key, unused

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
CROWD = 256  # buckets with more members are joined by byte of the other segment
HOT_ROWS = 100_000  # buckets with fewer members never count as hot
_SAMPLED = 200  # sampled members of a bucket that has a task's share of all fingerprints
_CHUNK = 1 << 15
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """Bit i is 1 if it is set in over half of the shingles' XXH64 (repeats count)."""
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)))
    if len(words) > size:
        starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, _CHUNK):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _CHUNK].tolist(), ends[at:at + _CHUNK].tolist())]
        h = np.array(part, dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """(id, r1, r2, fp): one row per input row; r1 and r2 identify (id, text)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, size) for t in b.column("t").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("r1"), b.column("r2"), pa.array(fp)],
                                             names=["id", "r1", "r2", "fp"])

    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    return (docs.select(F.col(id_col).alias("id"), k1.alias("r1"), k2.alias("r2"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, r1 long, r2 long, fp long"))


def _variants(fps: DataFrame) -> DataFrame:
    """64 rows per fingerprint; ``bucket`` names the segment, the wiped bit and what is left of the segment."""
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (fps.repartition(spread, "fp").select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("slot"))
            .select("fp", F.expr(
                "shiftleft(CAST(slot AS BIGINT), 32) |"
                " ((CASE WHEN slot < 32 THEN fp & 4294967295L ELSE shiftrightunsigned(fp, 32) END)"
                " & ~shiftleft(1L, slot % 32) & 4294967295L)").alias("bucket")))


def _hot_buckets(fps: DataFrame, least: int) -> DataFrame:
    """Buckets that hold, by a sample, over a 2P-th of all fingerprints and over ``least`` (P: shuffle partitions).

    A fingerprint is in 64 buckets, so there are at most some 128 P of them.  The
    sample decides where members meet their hub, not which hub it is."""
    parts = 2 * int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = fps.count()
    one_in = max(1, n // (_SAMPLED * parts))
    picked = fps.where(F.pmod(F.xxhash64(F.lit("sample"), "fp"), F.lit(one_in)) == 0)
    seen = _variants(picked).groupBy("bucket").agg(F.count("*").alias("n"))
    return materialize(seen.where(F.col("n") * one_in > max(least, n // parts)).select("bucket"), "simhash-hot")


def _members(fps: DataFrame, hot_rows: int) -> DataFrame:
    """(bucket, fp, hub) of the buckets with two fingerprints or more; the hub is the bucket's smallest."""
    hot, variants = _hot_buckets(fps, hot_rows), _variants(fps)
    any_hot = not hot.isEmpty()
    cold = variants.join(F.broadcast(hot), "bucket", "left_anti") if any_hot else variants
    whole = Window.partitionBy("bucket")
    found = cold.withColumns({"hub": F.min("fp").over(whole), "n": F.count("*").over(whole)})
    if any_hot:
        rows = variants.join(F.broadcast(hot), "bucket")
        hubs = rows.groupBy("bucket").agg(F.min("fp").alias("hub"), F.count("*").alias("n"))  # a row per hot bucket
        found = found.unionByName(rows.join(F.broadcast(hubs), "bucket"))
    return found.where(F.col("n") > 1).select("bucket", "fp", "hub")


def _apart(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def _cells(crowd: int):
    """-1 in a bucket of up to ``crowd`` members, else the four bytes of the other segment, told apart by place."""
    return F.expr(
        f"explode(CASE WHEN n <= {crowd} THEN array(-1L) ELSE transform(array(0, 1, 2, 3), i -> i * 256L +"
        " (shiftrightunsigned(fp, (CASE WHEN bucket < (32L * 4294967296L) THEN 32 ELSE 0 END) + 8 * i) & 255L)) END)")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b): root is the component's smallest node.

    Rounds of large-star and small-star links: in each, neighbours link to
    the smallest one around until all that is left are stars.  Each round's
    edges are written below the checkpoint root.
    """
    links = materialize(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # larger neighbours of a node go to the smallest around it
        large = (both.where(F.col("b") > F.col("a")).join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # a node and its smaller neighbours go to the smallest of these
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(floor, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(floor.select("a", F.col("m").alias("b")))
                 .where(F.col("a") != F.col("b")).distinct())
        after = materialize(small, "links")
        # stars: no node is both a leaf and a root, and each leaf has one root
        roots = after.select(F.col("b").alias("a")).distinct()
        leaves = after.groupBy("a").agg(F.count("*").alias("n"))
        open_nodes = leaves.join(roots, "a", "left_semi").count() + leaves.where(F.col("n") > 1).count()
        links = after
        if not open_nodes:
            break
    return (links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(fp, root): the component of every distinct fingerprint; links are ``max_bits`` or fewer bits.

    ``crowd`` and ``hot_rows`` only choose how a bucket's members meet; links are the same."""
    if max_bits > 3:
        raise ValueError("two segments with one wiped bit each cover distances up to 3")
    crowded = materialize(_members(fps, hot_rows), "simhash-members")
    stars = crowded.where((F.col("fp") != F.col("hub")) & (_apart(F.col("fp"), F.col("hub")) <= max_bits))
    first = materialize(components(stars.select(F.col("fp").alias("a"), F.col("hub").alias("b"))), "simhash-stars")

    member = (crowded.join(first.withColumnRenamed("node", "fp"), "fp", "left")
              .select("bucket", "fp", F.coalesce("root", "fp").alias("part")))
    mixed = (member.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("n"))
             .where(F.col("lo") != F.col("hi")).select("bucket", "n"))
    member = materialize(member.join(mixed, "bucket").select("bucket", _cells(crowd).alias("cell"), "fp", "part"),
                         "simhash-mixed")
    left, right = member.alias("l"), member.alias("r")
    across = (left.join(right, (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.cell") == F.col("r.cell"))
                        & (F.col("l.part") < F.col("r.part")) & (_apart(F.col("l.fp"), F.col("r.fp")) <= max_bits))
              .select(F.col("l.part").alias("a"), F.col("r.part").alias("b")).distinct())
    second = components(across)
    return (fps.join(first.withColumnRenamed("node", "fp"), "fp", "left")
            .select("fp", F.coalesce("root", "fp").alias("part"))
            .join(second.select(F.col("node").alias("part"), "root"), "part", "left")
            .select("fp", F.coalesce("root", "part").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: the id, r1, r2, ``fp`` (signed 64 bits), ``root`` and ``component_id``.

    A text without words (null, empty, blank) has fingerprint 0 and links like
    any other.  ``component_id`` is the smallest non-null id that can be
    reached over links, the row's own included; null if a component has only
    null ids.  Repeated rows are in one component with their copies.
    """
    slim = materialize(fingerprints(docs, id_col, text_col, size), "simhash-rows")
    fps = materialize(slim.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    linked = fps.join(link_fingerprints(fps.select("fp"), max_bits), "fp")
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = linked.select("fp", "root").join(named, "root")
    return (slim.join(classes, "fp")
            .select(F.col("id").alias(id_col), "r1", "r2", "fp", "root", "component_id"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS,
                  max_bits: int = MAX_BITS) -> DataFrame:
    """One document of every component, columns as given: the smallest id (nulls last), of repeated rows one."""
    r1, r2 = unused(docs, "r1"), unused(docs, "r2")
    rows = near_duplicates(docs, id_col, text_col, size, max_bits)
    best = (rows.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull(), F.col(id_col), "r1", "r2")).alias("b"))
            .select(F.col("b.r1").alias(r1), F.col("b.r2").alias(r2)))
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    kept = docs.withColumns({r1: k1, r2: k2}).join(best, [r1, r2], "left_semi")
    return kept.dropDuplicates([r1, r2]).select(*docs.columns)
