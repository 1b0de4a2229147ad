"""Reduces with a user's merge against a sequential fold."""

import random

import pytest
from pyspark.sql import functions as F

from tidepool.operators.fold import running_fold, window_fold


def _rows(n, hot):
    rnd = random.Random(5)
    names = ["hot"] * hot + ["a", "b", None, "c"]
    return [(i, rnd.choice(names), rnd.randint(0, 50), rnd.choice("xyz")) for i in range(n)]


def _join(a, b):
    """Not commutative and not a sum: first letter, last letter, changes between them."""
    return F.struct(a["first"].alias("first"), b["last"].alias("last"),
                    (a["changes"] + b["changes"] + (a["last"] != b["first"]).cast("int")).alias("changes"))


def _own():
    return F.struct(F.col("city").alias("first"), F.col("city").alias("last"), F.lit(0).alias("changes"))


@pytest.mark.parametrize("block", [2, 3, 64])
@pytest.mark.parametrize("hot", [0, 4])
def test_running_fold_equals_a_sequential_fold(spark, block, hot):
    rows = _rows(700, hot)
    df = spark.createDataFrame(rows, "i int, k string, v int, city string").repartition(5)
    got = {r["i"]: tuple(r["s"]) for r in running_fold(df, ["k"], ["i"], _own(), _join, "s", block=block).collect()}
    want, state = {}, {}
    for i, k, _, city in rows:
        first, last, n = state.get(k, (city, city, 0))
        state[k] = (first, city, n + (city != last))
        want[i] = state[k]
    assert got == want


def test_running_fold_joins_text_in_order(spark):
    df = spark.range(0, 130).select(F.col("id"), F.lit("one").alias("k"), F.col("id").cast("string").alias("t"))
    out = running_fold(df, ["k"], ["id"], F.col("t"), lambda a, b: F.concat_ws(",", a, b), "text", block=4)
    last = out.where(F.col("id") == 129).first()["text"]
    assert last == ",".join(str(i) for i in range(130))


def test_fold_of_an_empty_table_and_without_keys(spark):
    df = spark.createDataFrame(_rows(90, 0), "i int, k string, v int, city string")
    empty = running_fold(df.limit(0), ["k"], ["i"], F.col("v"), F.greatest, "m")
    assert empty.columns == ["i", "k", "v", "city", "m"] and empty.count() == 0
    top, want = 0, {}
    for i, _, v, _ in _rows(90, 0):
        top = max(top, v)
        want[i] = top
    assert {r["i"]: r["m"] for r in running_fold(df, [], ["i"], F.col("v"), F.greatest, "m", block=4).collect()} == want


def test_block_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        running_fold(spark.range(3), [], ["id"], F.col("id"), F.greatest, block=1)


def test_window_fold_gives_one_state_per_key_and_window(spark):
    rows = _rows(400, 3)
    df = spark.createDataFrame(rows, "i int, k string, v int, city string").withColumn("ts", F.timestamp_seconds("i"))
    got = {(r["k"], r["s0"]): tuple(r["s"]) for r in window_fold(df, "ts", "50 seconds", ["k"], ["i"], _own(), _join, "s", block=4)
           .withColumn("s0", F.unix_seconds("window_start")).collect()}
    want = {}
    for i, k, _, city in rows:
        at = (k, i // 50 * 50)
        first, last, n = want.get(at, (city, city, 0))
        want[at] = (first, city, n + (city != last))
    assert got == want
