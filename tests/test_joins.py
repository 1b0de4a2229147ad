"""Membership joins: broadcast only under the size limit, same rows either way."""

import contextlib
import io

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepool.operators.joins import fits, semi_join
from tidepool.operators.ordered import running_totals


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_semi_join_takes_each_row_once(spark):
    txns = spark.createDataFrame([(i, f"c{i % 7}") for i in range(100)], "id long, cust string")
    members = spark.createDataFrame([("c1",), ("c3",), ("c3",)], "cust_id string")
    hits = semi_join(txns, "cust", members, "cust_id")
    assert "strategy=broadcast" not in _plan(hits)  # no hint: statistics decide
    assert sorted(r["id"] for r in hits.collect()) == [i for i in range(100) if i % 7 in (1, 3)]


def test_fits_counts_bytes(spark):
    short, long = spark.createDataFrame([("k",)] * 50, "k string"), spark.createDataFrame([("k" * 1000,)] * 50, "k string")
    assert fits(short, 50 * 33) and not fits(short, 50 * 33 - 1) and not fits(long, 50 * 1000)


def test_bounded_join_needs_all_bounds_and_keeps_one_key(spark):
    import pytest
    from tidepool.operators.joins import equi_join
    a = spark.createDataFrame([(1, 10)], "k long, x long").withColumn("t1", F.timestamp_seconds("x"))
    b = spark.createDataFrame([(1, 20)], "k long, y long").withColumn("t2", F.timestamp_seconds("y"))
    with pytest.raises(ValueError):
        equi_join(a, b, "k", left_time="t1", right_time="t2", watermark="5 seconds")
    full = equi_join(a, b, "k", left_time="t1", right_time="t2", watermark="5 seconds", within="30 seconds")
    assert full.columns == ["k", "x", "t1", "y", "t2"] and full.count() == 1
    assert equi_join(a, b, "k").columns == ["k", "x", "t1", "y", "t2"]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 20),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=60),
       st.integers(1, 6))
def test_running_totals_property(spark, rows, n_chunks):
    df = spark.createDataFrame([(i, k, t, v) for i, (k, t, v) in enumerate(rows)],
                               "id long, k string, t long, v long")
    got = running_totals(df, ["k"], ["t", "id"], sums={"s": F.col("v")}, count_name="c",
                         n_chunks=n_chunks)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("*", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c"))
    assert sorted(got.collect()) == sorted(exp.select(*got.columns).collect())


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 12),
                          st.sampled_from(["X", "x", "Y", "", None])), min_size=1, max_size=50),
       st.integers(2, 5))
def test_change_counts_property(spark, rows, n_chunks):
    from tidepool.operators.ordered import change_counts
    df = spark.createDataFrame([(i, k, t, c) for i, (k, t, c) in enumerate(rows)],
                               "id long, k string, t long, city string")
    v = F.nullif(F.lower("city"), F.lit(""))
    got = change_counts(df, ["k"], ["t", "id"], v, n_chunks=n_chunks)
    # brute force in Python: walk each key in order
    exp = {}
    for k in {r[0] for r in rows}:
        last, n = None, 0
        for i, (kk, t, c) in sorted(((i, r) for i, r in enumerate(rows) if r[0] == k),
                                    key=lambda x: (x[1][1], x[0])):
            prev = last
            c = c.lower() if c else None
            if c is not None:
                if last is not None and c != last:
                    n += 1
                last = c
            exp[i] = (prev, n)
    assert {r["id"]: (r["prev_value"], r["n_changes"]) for r in got.collect()} == exp


def test_running_totals_independent_of_input_partitioning(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 11}", i % 97, i % 13)
                                for i in range(3000)], "id long, k string, t long, v long")
    a = running_totals(df, ["k"], ["t", "id"], sums={"s": F.col("v")}, count_name="c", n_chunks=12)
    b = running_totals(df.repartition(7).sortWithinPartitions(F.rand(3)), ["k"], ["t", "id"],
                       sums={"s": F.col("v")}, count_name="c", n_chunks=12)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
                          st.sampled_from([0, 1, 5, 10, 11, 40])), min_size=2, max_size=80),
       st.integers(2, 12))
def test_session_split_property(spark, steps, n_chunks):
    from tidepool.operators.windows import session, session_split
    t, rows = 0, []
    for i, (k, gap) in enumerate(steps):
        t += gap
        rows.append((i, k, t, i % 4))
    df = spark.createDataFrame(rows, "id long, k string, s long, v long") \
        .withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz"))
    got = session_split(df, "ts", "10 seconds", ["k"], {"total": F.col("v")}, "n", n_chunks=n_chunks)
    exp = session(df, "ts", "10 seconds", ["k"], {"total": F.sum("v"), "n": F.count(F.lit(1))})
    assert sorted(got.collect()) == sorted(exp.select(*got.columns).collect())


def test_flag_members_many_matches_separate_rules(spark):
    from tidepool.operators import rules

    txns = spark.createDataFrame([(i, f"c{i % 9}", f"k{i % 4}") for i in range(60)],
                                 "id long, cust string, card string")
    alarmed = spark.createDataFrame([("c1",), ("c2",), ("c2",)], "c string")
    lost = spark.createDataFrame([("k3",)], "k string")
    cols = ["id", "cust", "card"]
    separate = rules.union_alerts(
        rules.flag_members(txns, "cust", alarmed, "c", rules.RULE_ALARMED, cols),
        rules.flag_members(txns, "card", lost, "k", rules.RULE_LOST_CARD, cols))
    checks = [("cust", alarmed, "c", rules.RULE_ALARMED), ("card", lost, "k", rules.RULE_LOST_CARD)]
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    for limit in (before, "-1"):    # lists broadcast / shuffled
        spark.conf.set(key, limit)
        combined = rules.flag_members_many(txns, checks, cols)
        assert sorted(combined.collect()) == sorted(separate.select(*combined.columns).collect())
    spark.conf.set(key, before)
