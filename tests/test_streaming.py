"""Structured Streaming runs over multi-file fixtures (one file per micro-batch)."""

import datetime as dt
import os
import time

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepool.operators import rules, windows
from tidepool.operators.joins import ttl_join
from tests.compare import compare, duckdb_frame
from tests.conftest import SF001
from tidepool.streaming.catalog import STREAM_ORACLE_SQL, STREAM_QUERIES
from tidepool.streaming.operators import (flag_members_refreshed, processing_time_window, stream_city_changes,
                                          stream_rolling)
from tidepool.plans.catalog import EVENT_ORDER
from tidepool.streaming.ordered import activity_step, city_step, hold, rolling_step, run_in_order
from tidepool.streaming.runners import LateRowsDropped, event_stream, read_back, run_to_parquet, use_rocksdb_state

SCHEMA = "seller_id string, product string, quantity int, product_price double, sale_ts bigint"
T0 = int(dt.datetime(2024, 1, 1).timestamp() * 1000)


def _write_batches(folder, batches):
    """One file per micro-batch; the file source takes files in modification
    time order, so give them strictly increasing times."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        path = f"{folder}/part-{i:03d}.json"
        pd.DataFrame(rows, columns=["seller_id", "product", "quantity", "product_price", "sale_ts"]) \
            .to_json(path, orient="records", lines=True)
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


def _sales_stream(spark, folder):
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)
    return raw.withColumn("evttime", F.timestamp_millis("sale_ts")).withWatermark("evttime", "5 seconds")


def _s(sec):
    return T0 + int(sec * 1000)


def test_tumbling_stream_closed_windows_and_late_rows(spark, scratch):
    # Spark filters late rows with the watermark of the previous micro-batch
    # (eviction uses the current one), so a row is dropped only once two
    # watermark advances have passed it; here it arrives two batches after
    # its window [0,30) was closed and emitted.
    src = f"{scratch}/src"
    _write_batches(src, [
        [("LNK", "a", 1, 2.0, _s(1)), ("LNK", "b", 2, 1.5, _s(12)), ("NWK", "a", 1, 4.0, _s(20))],
        [("LNK", "a", 1, 2.0, _s(31)), ("NWK", "c", 3, 1.0, _s(40))],
        [("NWK", "c", 1, 1.0, _s(41))],
        [("LNK", "z", 100, 100.0, _s(25))],          # late by two batches -> dropped
        [("LNK", "a", 1, 1.0, _s(600))],             # moves the watermark far ahead
    ])
    sales = _sales_stream(spark, src)
    agg = windows.tumbling(sales, "evttime", "30 seconds", ["seller_id"], {
        "window_sales": F.sum(F.col("quantity") * F.col("product_price"))})
    out = read_back(spark, run_to_parquet(agg, "t", path=f"{scratch}/out"))
    got = {(r["seller_id"], r["window_start"].second): r["window_sales"] for r in out.collect()}
    assert got == {("LNK", 0): 5.0, ("NWK", 0): 4.0, ("LNK", 30): 2.0, ("NWK", 30): 4.0}


def test_session_stream_exact_gap_merges(spark, scratch):
    src = f"{scratch}/src"
    _write_batches(src, [
        [("LNK", "a", 1, 1.0, _s(0))],
        [("LNK", "a", 1, 1.0, _s(20))],              # exactly one gap later: same session
        [("LNK", "a", 1, 1.0, _s(100))],             # new session
        [("LNK", "a", 1, 1.0, _s(1000))],
    ])
    sales = _sales_stream(spark, src)
    agg = windows.session(sales, "evttime", "20 seconds", ["seller_id"], {"n": F.count(F.lit(1))})
    out = read_back(spark, run_to_parquet(agg, "s", path=f"{scratch}/out"))
    assert sorted(r["n"] for r in out.collect()) == [1, 2]


def test_sliding_stream_matches_batch(spark, scratch):
    src = f"{scratch}/src"
    rows = [("LNK", "a", 1, float(i), _s(7 * i)) for i in range(12)] + [("LNK", "a", 1, 0.0, _s(900))]
    _write_batches(src, [rows[:6], rows[6:12], rows[12:]])
    sales = _sales_stream(spark, src)
    agg = windows.sliding(sales, "evttime", "30 seconds", "10 seconds", ["seller_id"],
                          {"s": F.sum("product_price")})
    out = read_back(spark, run_to_parquet(agg, "sl", path=f"{scratch}/out"))
    batch = spark.createDataFrame(rows[:12], SCHEMA).withColumn("evttime", F.timestamp_millis("sale_ts"))
    exp = windows.sliding(batch, "evttime", "30 seconds", "10 seconds", ["seller_id"],
                          {"s": F.sum("product_price")})
    assert out.exceptAll(exp).count() == 0 and exp.exceptAll(out).count() == 0


def test_sliding_sums_stream_matches_batch(spark, scratch):
    """Panes of a stream, out of order between micro-batches within the delay, give the batch windows."""
    src = f"{scratch}/src"
    rows = [(f"s{i % 3}", "a", 1, float(i), _s(7 * i)) for i in range(40)] + [(None, "a", 1, 2.5, _s(33))]
    batches = [rows[:6] + rows[7:8], rows[6:7] + rows[8:21] + rows[40:], rows[22:30] + rows[21:22], rows[30:40],
               [("s0", "a", 1, 0.0, _s(900))]]
    batches[0].append(batches[1].pop())  # the null key comes early
    _write_batches(src, batches)
    # rows are at most 7 s older than the newest of an earlier batch
    sales = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src) \
        .withColumn("evttime", F.timestamp_millis("sale_ts")).withWatermark("evttime", "10 seconds")
    args = ("evttime", "30 seconds", "10 seconds", ["seller_id"], {"s": F.col("product_price")}, "n")
    out = read_back(spark, run_to_parquet(windows.sliding_sums(sales, *args), "sp", path=f"{scratch}/out", fail_on_late=True))
    batch = spark.createDataFrame(rows, SCHEMA).withColumn("evttime", F.timestamp_millis("sale_ts"))
    plain = windows.sliding(batch, *args[:4], {"s": F.sum("product_price"), "n": F.count(F.lit(1))})
    for exp in (windows.sliding_sums(batch, *args), plain):
        assert sorted(map(str, out.select(*exp.columns).collect())) == sorted(map(str, exp.collect()))


def test_stream_rolling_per_record(spark, scratch):
    src = f"{scratch}/src"
    _write_batches(src, [
        [("June", "Bat", 12, 0.0, 1), ("June", "Perfume", 10, 0.0, 2), ("July", "TV", 50, 0.0, 3)],
        [("June", "Shirt", 38, 0.0, 4), ("June", "Bat", 41, 0.0, 5)],
    ])
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    rolled = stream_rolling(raw.withColumn("q", F.col("quantity").cast("bigint")),
                            ["seller_id"], ["sale_ts"], "q")
    out = read_back(spark, run_to_parquet(rolled, "r", path=f"{scratch}/out"))
    got = sorted((r["sale_ts"], r["running_count"], r["running_sum"]) for r in out.collect())
    assert got == [(1, 1, 12), (2, 2, 22), (3, 1, 50), (4, 3, 60), (5, 4, 101)]


def test_stream_city_changes(spark, scratch):
    src = f"{scratch}/src"
    _write_batches(src, [
        [("c1", "Pune", 1, 0.0, _s(1)), ("c1", "Surat", 1, 0.0, _s(2)), ("c2", "Pune", 1, 0.0, _s(3))],
        [("c1", "surat", 1, 0.0, _s(4)), ("c1", "Goa", 1, 0.0, _s(5)), ("c1", "Pune", 1, 0.0, _s(6))],
        [("c1", "Goa", 1, 0.0, _s(3600))],
    ])
    sales = _sales_stream(spark, src).withColumn("id", F.col("sale_ts"))
    flagged = stream_city_changes(sales, "seller_id", "evttime", "10 seconds", "product",
                                  ["evttime", "id"], ["id"], 2)
    out = read_back(spark, run_to_parquet(flagged, "c", path=f"{scratch}/out"))
    got = sorted((r["seller_id"], r["id"] - T0, r["n_changes"]) for r in out.collect())
    assert got == [("c1", 5000, 2), ("c1", 6000, 3)]


def test_stream_static_membership_rule(spark, scratch):
    src = f"{scratch}/src"
    _write_batches(src, [[("a1", "x", 1, 1.0, _s(1)), ("b2", "x", 1, 1.0, _s(2))],
                         [("a1", "y", 1, 1.0, _s(3))]])
    members = spark.createDataFrame([("a1",)], "customer_id string")
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    flagged = rules.flag_members(raw, "seller_id", members, "customer_id", rules.RULE_ALARMED,
                                 ["seller_id", "product", "sale_ts"])
    out = read_back(spark, run_to_parquet(flagged, "m", path=f"{scratch}/out"))
    assert sorted(r["product"] for r in out.collect()) == ["x", "y"]


def test_processing_time_window_counts_every_row(spark, scratch):
    src = f"{scratch}/src"
    _write_batches(src, [[("a1", "x", 1, 1.0, 1), ("a1", "y", 2, 1.0, 2)], [("b2", "z", 1, 1.0, 3)]])
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    agg = processing_time_window(raw, "10 seconds", ["seller_id"], {"n": F.count(F.lit(1))})
    assert set(agg.columns) == {"seller_id", "window_start", "window_end", "n"}
    # arrival-time windows never close within a short test run, so read the
    # running counts from an update-mode memory sink (unit tests only)
    q = agg.writeStream.format("memory").queryName("proc_windows").outputMode("update") \
        .option("checkpointLocation", f"{scratch}/ckpt").start()
    q.processAllAvailable()
    q.stop()
    latest = spark.sql("SELECT seller_id, window_start, max(n) AS n FROM proc_windows "
                       "GROUP BY seller_id, window_start")
    assert sum(r["n"] for r in latest.collect()) == 3


def test_processing_time_window_closes_without_new_rows(spark, scratch):
    src = f"{scratch}/src"
    _write_batches(src, [[("a1", "x", 1, 1.0, 1), (None, "y", 2, 1.0, 2)], [("b2", "z", 1, 1.0, 3)]])
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    agg = processing_time_window(raw, "2 seconds", ["seller_id"], {"n": F.count(F.lit(1)), "q": F.sum("quantity")},
                                 heartbeat=True)
    assert set(agg.columns) == {"seller_id", "window_start", "window_end", "n", "q"}
    q = (agg.writeStream.format("memory").queryName("beats").outputMode("append")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(processingTime="500 milliseconds").start())
    try:
        until = time.time() + 90  # no file comes any more
        while time.time() < until and spark.table("beats").agg(F.sum("n")).first()[0] != 3:
            time.sleep(0.5)
    finally:
        q.stop()
    rows = spark.table("beats").collect()
    assert sorted((r["seller_id"] or "", r["n"], r["q"]) for r in rows) == [("", 1, 2), ("a1", 1, 1), ("b2", 1, 1)]
    assert all(r["window_end"] - r["window_start"] == dt.timedelta(seconds=2) for r in rows)


@pytest.mark.parametrize("ttl,found", [("1 hour", {("l1", "r1"), ("l1", "r2"), ("l4", "r4")}), ("2 seconds", {("l4", "r4")})])
def test_ttl_join_forgets_old_rows(spark, scratch, ttl, found):
    def side(name):
        return spark.readStream.schema(f"k string, {name} string").json(f"{scratch}/{name}")

    def add(name, n, *rows):
        os.makedirs(f"{scratch}/{name}", exist_ok=True)
        pd.DataFrame(rows, columns=["k", name]).to_json(f"{scratch}/{name}/{n}.json", orient="records", lines=True)

    use_rocksdb_state(spark)
    kept = []
    for n, (lefts, rights) in enumerate([
            ([("a", "l1"), (None, "l0")], [("z", "r0"), (None, "r00")]),
            ([("m", "l2")], [("n", "r3")]),               # time goes by on both sides
            ([("b", "l4")], [("b", "r4"), ("a", "r1"), ("a", "r2")])]):
        add("l", n, *lefts)
        add("r", n, *rights)
        q = (ttl_join(side("l"), side("r"), "k", ttl).writeStream.format("parquet").option("path", f"{scratch}/out")
             .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        kept.append(q.lastProgress.stateOperators[0].numRowsTotal)
        time.sleep(3)
    got = spark.read.schema("k string, l string, r string").parquet(f"{scratch}/out")
    assert sorted((r["l"], r["r"]) for r in got.collect()) == sorted(found)
    if ttl == "2 seconds":  # the third run's rows at most; the others have left the state
        assert kept[-1] <= 4
    else:
        assert kept[-1] >= 8
    left, right = (spark.createDataFrame([("a", f"{c}1"), ("a", f"{c}2"), (None, "x")], f"k string, {c} string") for c in "lr")
    assert ttl_join(left, right, "k", ttl).count() == 4  # tables: all pairs


def test_fan_out_split_from_one_stream(spark, scratch):
    """One stream, three outputs (pass-through, even as text, odd as numbers)
    written from one foreachBatch over a persisted micro-batch."""
    from tidepool.operators import split
    from tidepool.streaming.runners import run_foreach_batch

    src = f"{scratch}/src"
    os.makedirs(src)
    for i, chunk in enumerate([[454, 565, 45654], [767, 889, 78, -3]]):
        with open(f"{src}/part{i}.txt", "w") as f:
            f.write("\n".join(str(v) for v in chunk) + "\n")
        os.utime(f"{src}/part{i}.txt", (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    nums = spark.readStream.option("maxFilesPerTrigger", 1).text(src) \
        .select(F.col("value").cast("bigint").alias("n"))

    def handler(batch, epoch_id):
        batch.persist()
        outs = split.split_parity(batch, "n")
        outs["main"].write.mode("append").parquet(f"{scratch}/all")
        outs["even"].write.mode("append").parquet(f"{scratch}/even")
        outs["odd"].write.mode("append").parquet(f"{scratch}/odd")
        batch.unpersist()

    run_foreach_batch(nums, "fan", handler)
    assert spark.read.parquet(f"{scratch}/all").count() == 7
    assert sorted(r[0] for r in spark.read.parquet(f"{scratch}/even").collect()) == ["454", "45654", "78"]
    assert sorted(r[0] for r in spark.read.parquet(f"{scratch}/odd").collect()) == [-3, 565, 767, 889]


def test_stream_stream_join_with_time_bound(spark, scratch):
    from tidepool.operators.joins import equi_join

    a, b = f"{scratch}/scores", f"{scratch}/cats"
    _write_batches(a, [[("ann", "x", 7, 0.0, _s(1)), ("bob", "x", 3, 0.0, _s(2))],
                       [("ann", "y", 9, 0.0, _s(50))]])
    _write_batches(b, [[("ann", "gold", 0, 0.0, _s(3)), ("bob", "silver", 0, 0.0, _s(4))],
                       [("ann", "late", 0, 0.0, _s(500))]])
    left = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(a) \
        .select(F.col("seller_id").alias("name"), F.col("quantity").alias("score"),
                F.timestamp_millis("sale_ts").alias("t1"))
    right = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(b) \
        .select(F.col("seller_id").alias("name2"), F.col("product").alias("que"),
                F.timestamp_millis("sale_ts").alias("t2"))
    joined = equi_join(left.withColumnRenamed("name", "k"), right.withColumnRenamed("name2", "k"), "k",
                       left_time="t1", right_time="t2", watermark="10 seconds", within="30 seconds")
    out = read_back(spark, run_to_parquet(joined.select("k", "score", "que"), "j", path=f"{scratch}/out"))
    assert sorted((r["k"], r["score"], r["que"]) for r in out.collect()) == [
        ("ann", 7, "gold"), ("bob", 3, "silver")]


def test_stream_bucketed_and_text_sinks(spark, scratch):
    from tidepool.sinks.files import stream_bucketed, stream_text

    src = f"{scratch}/src"
    _write_batches(src, [[("LNK", "a", 1, 2.0, _s(1))], [("NWK", "b", 2, 1.5, _s(3700))]])
    sales = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src) \
        .withColumn("evttime", F.timestamp_millis("sale_ts"))
    q = stream_bucketed(sales, f"{scratch}/b", f"{scratch}/ck_b", fmt="json", time_col="evttime")
    q.awaitTermination()
    assert sorted(os.listdir(f"{scratch}/b")) == ["_spark_metadata", "bucket=2024-01-01--00",
                                                   "bucket=2024-01-01--01"]
    q = stream_text(sales.select("seller_id", "quantity"), f"{scratch}/t", f"{scratch}/ck_t")
    q.awaitTermination()
    assert sorted(r[0] for r in spark.read.text(f"{scratch}/t").collect()) == ["(LNK,1)", "(NWK,2)"]


# -- catalogue streams over a table that is a folder of part files ------------

def _foldered(spark, scratch, n=5):
    """The events table as part files split by time, in time order."""
    from tests.conftest import SF001

    os.makedirs(f"{scratch}/sf/events.parquet")
    ev = pd.read_parquet(f"{SF001}/events.parquet").sort_values(["ts", "event_id"])
    step = -(-len(ev) // n)
    for i in range(n):
        path = f"{scratch}/sf/events.parquet/part-{i:03d}.parquet"
        ev.iloc[i * step:(i + 1) * step].to_parquet(path, index=False, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    for t in ("customer", "supplier"):
        pd.read_parquet(f"{SF001}/{t}.parquet").to_parquet(f"{scratch}/sf/{t}.parquet", index=False)
    return f"{scratch}/sf"


@pytest.fixture()
def one_file_per_trigger(spark):
    from tidepool.streaming.runners import FILES_PER_TRIGGER
    spark.conf.set(FILES_PER_TRIGGER, "1")
    yield
    spark.conf.unset(FILES_PER_TRIGGER)


@pytest.mark.parametrize("name", sorted(STREAM_QUERIES))
def test_catalogue_streams_over_part_files_and_micro_batches(spark, scratch, one_file_per_trigger, name):
    sf = _foldered(spark, scratch)
    got = STREAM_QUERIES[name](spark, sf).toPandas()
    con = duckdb.connect()
    for t, path in (("events", "events.parquet/*.parquet"), ("customer", "customer.parquet"), ("supplier", "supplier.parquet")):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{path}')")
    want = con.execute(STREAM_ORACLE_SQL[name]).df()
    ok, msg = compare(got, want)
    assert ok and (len(got) > 0 or len(want) == 0), msg


def test_late_rows_fail_the_run(spark, scratch, one_file_per_trigger):
    sf = _foldered(spark, scratch)
    for i in range(5):  # newest rows first
        os.utime(f"{sf}/events.parquet/part-{i:03d}.parquet", (1_700_000_000 - 10 * i,) * 2)
    with pytest.raises(LateRowsDropped):
        STREAM_QUERIES["stream_tumbling"](spark, sf)


def test_member_list_is_read_again_for_every_micro_batch(spark, scratch):
    src = f"{scratch}/src"
    _write_batches(src, [[("a1", "x", 1, 1.0, 1), ("b2", "x", 1, 1.0, 2)], [("a1", "y", 1, 1.0, 3), ("b2", "y", 1, 1.0, 4)]])
    spark.createDataFrame([("a1",)], "m string").write.parquet(f"{scratch}/members")
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    calls = []

    def lists(session):
        if calls:  # a member is added while the query runs
            session.createDataFrame([("b2",)], "m string").write.mode("append").parquet(f"{scratch}/members")
        calls.append(1)
        return [("seller_id", session.read.parquet(f"{scratch}/members"), "m", rules.RULE_ALARMED)]

    out = flag_members_refreshed(raw, lists, ["seller_id", "product"])
    assert sorted((r["seller_id"], r["product"]) for r in out.collect()) == [("a1", "x"), ("a1", "y"), ("b2", "y")]


def test_rolling_stream_skips_null_values(spark, scratch):
    os.makedirs(f"{scratch}/src")
    with open(f"{scratch}/src/a.json", "w") as f:
        f.write('{"k": "a", "i": 1, "v": 5}\n{"k": "a", "i": 2, "v": null}\n{"k": "a", "i": 3, "v": 2}\n')
    raw = spark.readStream.schema("k string, i long, v long").json(f"{scratch}/src")
    out = read_back(spark, run_to_parquet(stream_rolling(raw, ["k"], ["i"], "v"), "n", path=f"{scratch}/out"))
    assert sorted((r["i"], r["running_count"], r["running_sum"]) for r in out.collect()) == [(1, 1, 5), (2, 2, 5), (3, 3, 7)]


def _overlapping(scratch, part_rows):
    """An events table of part files, one for each list of (event_id, seconds, user, type, value)."""
    os.makedirs(f"{scratch}/sf/events.parquet")
    for i, rows in enumerate(part_rows):
        path = f"{scratch}/sf/events.parquet/part-{i:03d}.parquet"
        ev = pd.DataFrame([(e, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), u, t, v, '{"k": 1}') for e, s, u, t, v in rows],
                          columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
        ev.to_parquet(path, index=False, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    for t in ("customer", "supplier"):
        pd.read_parquet(f"/root/testdata/sf0.001/{t}.parquet").to_parquet(f"{scratch}/sf/{t}.parquet", index=False)
    return f"{scratch}/sf"


CLOSING = (99, 100_000, 1, "z", 1.0)  # far in the future: the watermark passes all rows before


@pytest.mark.parametrize("name", ["stream_rolling_sums", "stream_alerts"])
def test_part_files_that_overlap_within_the_delay_come_in_event_order(spark, scratch, one_file_per_trigger, name):
    # event 3 stands between 1 and 2 but comes a micro-batch later, inside the 5 s that the watermark allows
    sf = _overlapping(scratch, [[(1, 0, 7, "a", 1.0), (2, 3, 7, "a", 2.0)], [(3, 1, 7, "b", 4.0), (4, 2, 7, "a", 8.0)],
                                [(5, 4, 7, "b", 1.0), (6, 2, 8, "b", 1.0)], [CLOSING]])
    got = STREAM_QUERIES[name](spark, sf).toPandas()
    con = duckdb.connect()
    for t, path in (("events", "events.parquet/*.parquet"), ("customer", "customer.parquet"), ("supplier", "supplier.parquet")):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{path}')")
    ok, msg = compare(got, con.execute(STREAM_ORACLE_SQL[name]).df())
    assert ok, msg
    if name == "stream_rolling_sums":
        assert sorted(zip(got["event_id"], got["running_count"], got["running_sum"])) == [
            (1, 1, 100), (2, 3, 1100), (3, 1, 400), (4, 2, 900), (5, 3, 600), (6, 2, 500), (99, 1, 100)]


def test_rows_later_than_the_delay_fail_event_order(spark, scratch, one_file_per_trigger):
    sf = _overlapping(scratch, [[(1, 0, 7, "a", 1.0)], [(2, 5000, 7, "a", 2.0)], [(3, 9000, 7, "a", 2.0)], [(4, 1, 7, "a", 8.0)],
                                [CLOSING]])
    with pytest.raises(LateRowsDropped):
        STREAM_QUERIES["stream_rolling_sums"](spark, sf)


def test_ties_of_time_over_micro_batches_go_by_the_tie_breaker(spark, scratch, one_file_per_trigger):
    sf = _overlapping(scratch, [[(2, 3, 7, "a", 2.0), (1, 3, 7, "a", 1.0)], [(4, 3, 7, "a", 8.0), (9, 1, 7, "b", 1.0)], [CLOSING]])
    got = STREAM_QUERIES["stream_rolling_sums"](spark, sf).collect()
    assert sorted((r["event_id"], r["running_count"], r["running_sum"]) for r in got) == [
        (1, 1, 100), (2, 2, 300), (4, 3, 1100), (9, 1, 100), (99, 1, 100)]


@pytest.mark.parametrize("name", ["stream_rolling_sums", "stream_alerts"])
def test_rows_still_held_and_rows_without_a_time_come_when_the_feed_ends(spark, scratch, one_file_per_trigger, name):
    # user 7 changes city in the last ten minutes; a window of 30 days ends 2024-01-18, between the last release and the watermark
    end = 17 * 86_400
    sf = _overlapping(scratch, [[(i, end - 9_000 + i, 8, "ab"[i % 2], 1.0) for i in range(50)],
                                [(60 + i, end + 6 + i % 2, 7, "abc"[i % 3], 2.0) for i in range(5)]])
    ts = pd.Series([None, None, None], dtype="datetime64[us]")
    late = pd.DataFrame({"event_id": [2, 72, 71], "ts": ts, "user_id": [7, 7, 7], "event_type": ["a", "a", "b"],
                         "value": [1.0, 2.0, 4.0], "props": ['{"k": 1}'] * 3})
    late.to_parquet(f"{sf}/events.parquet/part-009.parquet", index=False, coerce_timestamps="us")
    got = STREAM_QUERIES[name](spark, sf).toPandas()
    con = duckdb.connect()
    for t, path in (("events", "events.parquet/*.parquet"), ("customer", "customer.parquet"), ("supplier", "supplier.parquet")):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{path}')")
    want = con.execute(STREAM_ORACLE_SQL[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg
    if name == "stream_rolling_sums":
        assert len(got) == 58
    else:
        assert {"excessive_activity", "frequent_city_change"} <= set(got["rule"])
        assert {61, 63, 64, 72} <= set(got.loc[got["rule"] == "frequent_city_change", "event_id"])


def _ordered_run(spark, src, out):
    ev = event_stream(spark, src, max_files_per_trigger=1).withWatermark("evt", "5 seconds").select(
        "user_id", "event_type", *EVENT_ORDER, "evt", F.col("value").cast("bigint").alias("v"))
    return run_in_order(hold(ev, "evt", EVENT_ORDER), "ordered", {
        "sums": rolling_step(["user_id"], EVENT_ORDER, "v"),
        "moves": city_step("user_id", "evt", "1 day", "event_type", EVENT_ORDER, [], 2),
        "busy": activity_step("user_id", "evt", "1 day", EVENT_ORDER, ["user_id", "event_id"], 2)}, path=out)


def test_a_later_run_and_a_repeated_batch_go_on_from_what_was_carried(spark, scratch):
    day = 86_400
    rows = [(i, 700 * i, i % 3, "abca"[i % 4], float(i)) for i in range(1, 300)]
    sf = _overlapping(scratch, [rows[:100], rows[100:150]])
    first = {k: v.count() for k, v in _ordered_run(spark, sf, f"{scratch}/out").items()}
    more = pd.DataFrame([(e, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), u, t, v, '{"k": 1}')
                         for e, s, u, t, v in [*rows[150:], (998, 8 * day, 5, "z", 0.0), (999, 9 * day, 5, "z", 0.0)]],
                        columns=["event_id", "ts", "user_id", "event_type", "value", "props"])
    more.to_parquet(f"{sf}/events.parquet/part-900.parquet", index=False, coerce_timestamps="us")
    # the last micro-batch is forgotten, as if the run had died before its commit: it is repeated
    commits = sorted((int(c) for c in os.listdir(f"{scratch}/out/_checkpoint/commits") if c.isdigit()))
    for at in (f"{scratch}/out/_checkpoint/commits/{commits[-1]}", f"{scratch}/out/_checkpoint/commits/.{commits[-1]}.crc"):
        if os.path.exists(at):
            os.remove(at)
    got = _ordered_run(spark, sf, f"{scratch}/out")
    want_sums, want_moves, per_day = [], [], {}
    for user in range(3):
        n = total = 0
        last, changes, today = None, 0, None
        for e, s, u, t, v in rows:
            if u != user:
                continue
            n, total = n + 1, total + int(v)
            want_sums.append((e, n, total))
            if s // day != today:
                last, changes, today = None, 0, s // day
            changes += last is not None and t != last
            last = t
            if changes >= 2:
                want_moves.append((e, changes))
            per_day.setdefault((user, s // day), []).append(e)
    assert sorted((r["event_id"], r["running_count"], r["running_sum"]) for r in got["sums"].collect()
                  if r["user_id"] < 5) == sorted(want_sums)
    assert sorted((r["event_id"], r["n_changes"]) for r in got["moves"].collect()) == sorted(want_moves)
    assert sorted((r["user_id"], r["event_id"], r["n"]) for r in got["busy"].collect()) == sorted(
        (u, es[0], len(es)) for (u, _), es in per_day.items() if len(es) > 2)
    assert 0 < first["sums"] < len(want_sums)


def test_event_order_queries_run_without_python(spark, scratch):
    sf = _overlapping(scratch, [[(1, 0, 7, "a", 1.0)], [CLOSING]])
    ev = event_stream(spark, sf).withWatermark("evt", "5 seconds")
    plan = hold(ev, "evt", EVENT_ORDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_late_feed_drops_rows_behind_the_watermark_only(spark):
    closed = duckdb_frame("SELECT COUNT(*) FROM events WHERE time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' "
                          "<= (SELECT MAX(ts) FROM events) - INTERVAL '5 seconds'", SF001).iloc[0, 0]
    counted = STREAM_QUERIES["stream_late_rows"](spark, SF001).agg(F.sum("n_events")).first()[0]
    assert closed * 0.9 <= counted < closed
