"""Plan-shape guards: the physical plans stay the ones the design relies on."""

import contextlib
import io
import re

import pytest

from scripts.plan_report import summarise
from tests.conftest import SF01
from tidepool.plans.catalog import BATCH_QUERIES


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(fn(spark, SF01)) for name, fn in BATCH_QUERIES.items()}


def test_no_python_in_batch_plans(plans):
    assert {n: summarise(p)["python"] for n, p in plans.items() if summarise(p)["python"]} == {}


@pytest.mark.parametrize("name", ["tumbling_revenue", "window_reduce", "window_global",
                                  "excessive_activity", "word_count", "group_count", "distinct_where"])
def test_single_shuffle_with_partial_aggregate(plans, name):
    p = plans[name]
    assert summarise(p)["shuffles"] == 1
    nodes = re.findall(r"^\(\d+\) (\w[\w ]*?)\s*$", p, re.M)
    first_exchange = nodes.index("Exchange")
    # map-side partial aggregate; "first row by (ts, id)" (min_by over a
    # struct) has a variable-width buffer, so Spark sorts then aggregates
    assert {"HashAggregate", "SortAggregate"} & set(nodes[:first_exchange])


def test_filters_and_columns_reach_the_scan(plans):
    assert "LessThan(c_acctbal,0.0)" in plans["flag_alarmed"]
    assert "LessThan(s_acctbal,0.0)" in plans["flag_lost_card"]
    assert "LessThan(value,5.0)" in plans["distinct_where"]
    assert "EqualTo(o_orderstatus,F)" in plans["trips_by_destination"]
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plans["distinct_where"]
    assert "ReadSchema: struct<o_orderkey:bigint>" in plans["split_even"]


def test_chunked_scan_broadcasts_only_bounded_tables(plans):
    # the heavy keys' boundaries (read by the rows and by the summary) and the carry table
    s = summarise(plans["rolling_count"])
    assert s["broadcasts"] <= 3 and s["windows"] == 2


@pytest.mark.parametrize("name", ["sliding_revenue", "sliding_revenue_sql"])
def test_sliding_windows_expand_panes_not_rows(plans, name):
    nodes = re.findall(r"^\(\d+\) (\w[\w ]*?)\s*$", plans[name], re.M)
    assert "HashAggregate" in nodes[:nodes.index("Expand")] and "SortAggregate" not in nodes


@pytest.mark.parametrize("name", ["session_revenue", "session_revenue_sql"])
def test_sessions_add_rows_up_before_any_shuffle(plans, name):
    nodes = re.findall(r"^\(\d+\) (\w[\w ]*?)\s*$", plans[name], re.M)
    assert "HashAggregate" in nodes[:nodes.index("Exchange")] and summarise(plans[name])["scans"] == 1


def test_alert_union_plans_without_eager_jobs(spark):
    from pyspark.sql import functions as F
    from tidepool.operators import rules
    bad = spark.range(5).select(F.raise_error(F.lit("planned eagerly")).cast("long").alias("m"))
    txns = spark.range(5).withColumnRenamed("id", "k")
    rules.flag_members_many(txns, [("k", bad, "m", "r")], ["k"])  # raises if it ran a job


def test_many_ranges_compile(spark):
    from pyspark.sql import functions as F
    from tidepool.operators.ordered import with_chunks
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.range(60_000).select(F.col("id"), (F.col("id") % 3).alias("k"), (F.xxhash64("id") % 10**6).alias("t"))
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        tagged, plan = with_chunks(df, ["k"], ["t", "id"])
        per = tagged.groupBy("k", "_chunk").count().agg(F.max("count"), F.count("*")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.codegen.fallback")
    assert plan.n_chunks > 2000 and per[1] > 1500 and per[0] < 400
