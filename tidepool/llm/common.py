"""Pieces that several training-data operators share.

Conventions of the whole subpackage:

* words are maximal runs of ``[^\\x20\\x09-\\x0D]``, lower-casing touches A-Z only;
* a null text counts as an empty one unless an operator says otherwise;
* columns an operator adds to rows of the input get names that the input does
  not use (``unused``), so clashing names stay untouched;
* an intermediate result that is read more than once, or that ends a long
  lineage, is written below ``spark.checkpoint.dir`` and read back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import configure, scratch_path

SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows per Arrow batch: texts may be long, so batches stay small.
ARROW_ROWS = 256
# Bytes of text that a Python worker splits into words at a time.
SLICE_BYTES = 4 << 20
_REMEMBERED = 1 << 18


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with the session settings the operators need."""
    configure(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(ARROW_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z, leave every other character alone."""
    return F.translate(col, _UPPER, _UPPER.lower())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below the checkpoint root and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name += "_"
    return name


def numbered_copies(df: DataFrame, key: list[str], name: str, counted: DataFrame | None = None, shares: int = 1024) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... among the rows that are equal in ``key`` (and so may be numbered in any order).

    ``key`` has no nulls.  A group of at least a ``shares``-th of all rows (there
    are at most ``shares``) is numbered in two steps, so that it is not in one
    task: within salts, written first, and from where the salts before end.
    ``counted`` may be a slimmer table with the same keys, to count them."""
    counted = df if counted is None else counted
    least = max(2, shares, -(-counted.count() // shares))
    heavy = counted.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(*key).collect()
    plain = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    if not heavy:
        return df.withColumn(name, plain)
    heavy = F.broadcast(df.sparkSession.createDataFrame(heavy, df.select(*key).schema))
    salt, before, n = unused(df, "salt"), unused(df, "before"), unused(df, "n")
    salted = materialize(df.join(heavy, key, "left_semi").select(*df.columns).withColumn(
        salt, F.pmod(F.monotonically_increasing_id(), F.lit(4 * shares)).cast("int")), "copies")
    ahead = Window.partitionBy(*key).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.groupBy(*key, salt).agg(F.count("*").alias(n))  # a row per group and salt
              .select(*key, salt, F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(before)))
    within = F.row_number().over(Window.partitionBy(*key, salt).orderBy(*key))
    dealt = (salted.withColumn(name, within).join(starts, [*key, salt])
             .withColumn(name, (F.col(name) + F.col(before)).cast("int")).select(*df.columns, name))
    return df.join(heavy, key, "left_anti").select(*df.columns).withColumn(name, plain).unionByName(dealt)


def row_key(*cols: Column) -> tuple[Column, Column]:
    """128-bit identity of a row's values as two longs; never null."""
    parts = [x for c in cols for x in (c.isNull(), c)]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_interval(hashed: Column) -> Column:
    """A 64-bit hash as a double in [0, 1) (its upper 53 bits)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(1 << 53))


def rows(spark: SparkSession, values: list[tuple], schema: str) -> DataFrame:
    """A few constant rows as a plain relation (``schema`` in DDL form)."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    names = [f[0] for f in fields]
    if not values:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in fields])
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)]) for row in values]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("x")).select(*[F.col(f"x.{n}").alias(n) for n in names])


class WordHashes(dict):
    """64-bit hashes of words; those seen lately are remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


HASHES = WordHashes()


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The rows of an Arrow batch in parts of about ``SLICE_BYTES`` of text; a longer text is a part of its own."""
    sizes = pc.binary_length(batch.column(text)).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(x or 0 for x in sizes):
        if i > start and held + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows:
        yield batch.slice(start)
