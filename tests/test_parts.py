"""Several file sinks of one stream, with failures between them."""

import os
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidepool.streaming.parts import fan_out, written


def _numbers(folder, part, values):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/part-{part}.txt"
    with open(path, "w") as f:
        f.write("".join(f"{v}\n" for v in values))
    os.utime(path, (1_700_000_000 + 10 * part,) * 2)


def _stream(spark, folder):
    return spark.readStream.option("maxFilesPerTrigger", 1).text(folder).select(F.col("value").cast("int").alias("v"))


def _even(batch):
    return batch.where(F.col("v") % 2 == 0)


def _odd(batch):
    return batch.where(F.col("v") % 2 == 1)


def _values(spark, folder):
    return sorted(r["v"] for r in written(spark, folder).collect())


def test_a_batch_that_fails_between_two_sinks_leaves_each_row_once(spark, scratch):
    src, root = f"{scratch}/src", f"{scratch}/out"
    _numbers(src, 0, range(10))
    _numbers(src, 1, range(10, 30))
    failing = [True]

    def odd(batch):
        if failing and batch.where(F.col("v") == 11).count():
            failing.pop()
            raise RuntimeError("the second sink is away")
        return _odd(batch)

    with pytest.raises(StreamingQueryException):
        fan_out(_stream(spark, src), {"even": _even, "odd": odd}, root)
    assert _values(spark, f"{root}/even") == list(range(0, 30, 2))
    assert _values(spark, f"{root}/odd") == [1, 3, 5, 7, 9]
    first = {r["bucket"] for r in written(spark, f"{root}/even").collect()}
    before = sorted(os.listdir(f"{root}/even/batch=1/bucket={first.copy().pop()}"))
    _numbers(src, 2, range(30, 34))
    fan_out(_stream(spark, src), {"even": _even, "odd": odd}, root)
    assert _values(spark, f"{root}/even") == list(range(0, 34, 2))
    assert _values(spark, f"{root}/odd") == list(range(1, 34, 2))
    assert sorted(os.listdir(f"{root}/even/batch=1/bucket={first.pop()}")) == before  # left as it was


def test_parts_hold_a_bounded_number_of_rows_in_hourly_buckets(spark, scratch):
    src, root = f"{scratch}/src", f"{scratch}/out"
    _numbers(src, 0, range(100))
    fan_out(_stream(spark, src), {"all": lambda b: b.coalesce(1)}, root, rows_per_part=30)
    buckets = [x for x in os.listdir(f"{root}/all/batch=0") if x.startswith("bucket=")]
    assert buckets and all(re.fullmatch(r"bucket=\d{4}-\d\d-\d\d--\d\d", x) for x in buckets)
    parts = [x for b in buckets for x in os.listdir(f"{root}/all/batch=0/{b}") if x.endswith(".parquet")]
    assert len(parts) >= 4 and _values(spark, f"{root}/all") == list(range(100))


def test_a_folder_cut_short_is_not_read_and_written_anew(spark, scratch):
    src, root = f"{scratch}/src", f"{scratch}/out"
    _numbers(src, 0, [1, 2])
    _numbers(src, 1, [3])
    os.makedirs(f"{root}/all/batch=1/bucket=2000-01-01--00")  # a dead run got no further
    with pytest.raises(ValueError):
        written(spark, f"{root}/all")
    fan_out(_stream(spark, src), {"all": lambda b: b}, root)
    assert _values(spark, f"{root}/all") == [1, 2, 3]
    assert not os.path.exists(f"{root}/all/batch=1/bucket=2000-01-01--00")
