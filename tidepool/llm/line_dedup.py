"""Line dedup through sharded perfect-hash arrays.

1. Every line long enough becomes ``(document row, position, 128-bit key
   hash)``; that slim table is written once.
2. Per distinct hash: in how many documents it stands and the largest
   ``doc_id`` among them.  The distinct hashes are dealt into shards of about
   ``SHARD_KEYS``; each shard becomes one blob: a minimal perfect hash with
   fingerprint, count and keeper arrays.
3. Line probes travel to their shard (16-byte hash and position, no text) and
   are answered from the arrays in a stream, the blob ahead of its probes, so
   a task holds one shard and one batch.  Lines found in a very large share of
   the documents would all go to one shard; there are at most ``HOT_LINES`` of
   them (their shares add up to one), so they sit in one small blob that is
   sent to every task, and their probes are answered before the exchange.
4. Positions to drop go back to their document, the only exchange of texts.

A shard holds every distinct line of rows with an id.  Other lines probe too:
all of them the hot blob, and those of rows with a null id their shard.  The
fingerprint is the whole key, so a line that is not held is never taken for one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, ascii_lower, materialize, row_key
from .perfect_hash import LineIndex

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 1 << 16
HOT_LINES = 4096

_ENTRY, _PROBE, _DROP = 0, 1, 2
_STREAM = "shard long, kind int, blob binary, r1 long, r2 long, pos int, id long, h1 long, h2 long"


def _segments(*cols: np.ndarray):
    """Runs of equal values: (first row, row after the last)."""
    if not len(cols[0]):
        return
    cut = np.zeros(len(cols[0]), bool)
    for c in cols:
        cut[1:] |= c[1:] != c[:-1]
    edges = [0, *np.flatnonzero(cut).tolist(), len(cut)]
    yield from zip(edges[:-1], edges[1:])


def _numpy(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False)


def _dropped(index: LineIndex, batch: pa.RecordBatch, rows: slice, min_docs: int):
    """(known, to drop) of the rows' probes."""
    h1, h2 = (np.ascontiguousarray(_numpy(batch, c)[rows]) for c in ("h1", "h2"))
    count, keeper = index.probe(h1, h2)
    ids = _numpy(batch, "id")[rows]
    none = np.asarray(batch.column("id").is_null())[rows]
    return count > 0, (count >= min_docs) & (none | (keeper != ids))


def _answer_hot(blob: bytes, shards: int, min_docs: int):
    def run(batches):
        index = LineIndex.from_bytes(blob)
        schema = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary()), ("r1", pa.int64()),
                            ("r2", pa.int64()), ("pos", pa.int32()), ("id", pa.int64()), ("h1", pa.int64()),
                            ("h2", pa.int64())])
        for b in batches:
            known, drop = _dropped(index, b, slice(None), min_docs)
            # answered drops take any shard's way to their document
            to = np.where(known, _numpy(b, "r1") % shards, _numpy(b, "h1") % shards)
            kind = np.where(known, _DROP, _PROBE).astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [pa.array(to), pa.array(kind), pa.nulls(b.num_rows, pa.binary()),
                 *(b.column(c) for c in ("r1", "r2", "pos", "id", "h1", "h2"))], schema=schema)
            yield out.filter(pa.array(~known | drop))
    return run


def _answer(min_docs: int):
    def run(batches):
        index = held = None
        for b in batches:
            kind, shard = _numpy(b, "kind"), _numpy(b, "shard")
            keep = kind == _DROP
            for lo, hi in _segments(shard, kind):
                if kind[lo] == _ENTRY:
                    index, held = LineIndex.from_bytes(b.column("blob")[hi - 1].as_py()), shard[lo]
                elif kind[lo] == _PROBE and held == shard[lo]:
                    keep[lo:hi] = _dropped(index, b, slice(lo, hi), min_docs)[1]
            yield b.select(["r1", "r2", "pos"]).filter(pa.array(keep))
    return run


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    index = LineIndex.build(pdf["h1"].to_numpy(), pdf["h2"].to_numpy(), pdf["n"].to_numpy(), pdf["keeper"].to_numpy())
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "blob": [index.to_bytes()]})


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, drop: pd.Series) -> pd.Series:
    def one(t, d):
        if d is None or not len(d):
            return t
        gone = set(d)
        return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)

    return pd.Series([one(t, d) for t, d in zip(text, drop)], dtype=object)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Drop lines that many documents share, but for their largest ``doc_id``.

    A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
    lower-cased.  Keys of ``min_chars`` code points or more that stand in
    ``min_docs`` documents or more (distinct non-null ids) lose all their
    lines except in the largest id that holds them.

    Returns one row per input row: the id, ``n_lines``, ``n_dropped`` and
    ``kept`` (the other lines joined by a line feed).  A null or empty text is
    one empty line.  Rows with a null id hold no claim to a line: they count
    towards no key and lose every line that is dropped elsewhere.  Repeated
    rows of one id count as one document and are treated alike.  If every
    line goes, ``kept`` is empty.  Ids are integers.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    k1, k2 = row_key(F.col("id"), F.col("t"))
    base = base.select("id", "t", k1.alias("r1"), k2.alias("r2"))

    cut = base.select("id", "r1", "r2", F.posexplode(F.split("t", "\n")).alias("pos", "line"))
    key = cut.select("id", "r1", "r2", "pos", ascii_lower(F.btrim("line", F.lit(SPACES))).alias("k"))
    lines = materialize(
        key.where(F.char_length("k") >= min_chars)
        .select("id", "r1", "r2", "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(7), "k").alias("h2")),
        "line-hashes")

    counts = materialize(
        lines.where(F.col("id").isNotNull()).select("h1", "h2", "id").distinct()
        .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keeper")),
        "line-counts")
    stats = counts.agg(F.count("*").alias("keys"), F.sum("n").alias("held")).first()
    shards = max(1, -(-stats["keys"] // SHARD_KEYS))

    # shares of at least 1/HOT_LINES: no more than HOT_LINES lines can have one
    hot_from = max(min_docs, -(-(stats["held"] or 0) // HOT_LINES))
    hot = counts.where(F.col("n") >= hot_from) if (stats["held"] or 0) > HOT_LINES else counts.limit(0)
    hot = hot.toPandas()
    hot_blob = LineIndex.build(hot["h1"].to_numpy(np.int64), hot["h2"].to_numpy(np.int64),
                               hot["n"].to_numpy(np.int64), hot["keeper"].to_numpy(np.int64)).to_bytes()

    entries = (counts.withColumn("shard", F.pmod("h1", F.lit(shards))).groupBy("shard")
               .applyInPandas(_build, "shard long, blob binary")
               .select("shard", F.lit(_ENTRY).alias("kind"), "blob",
                       *(F.lit(None).cast(t).alias(c) for c, t in
                         (("r1", "long"), ("r2", "long"), ("pos", "int"), ("id", "long"), ("h1", "long"), ("h2", "long")))))
    probes = lines.mapInArrow(_answer_hot(hot_blob, shards, min_docs), _STREAM)
    drops = (entries.unionByName(probes).repartition("shard").sortWithinPartitions("shard", "kind")
             .mapInArrow(_answer(min_docs), "r1 long, r2 long, pos int")
             .groupBy("r1", "r2").agg(F.collect_set("pos").alias("drop")))

    return (base.join(drops, ["r1", "r2"], "left")
            .select(F.col("id").alias(id_col),
                    F.size(F.split("t", "\n")).cast("long").alias("n_lines"),
                    F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
                    _kept("t", "drop").alias("kept")))
