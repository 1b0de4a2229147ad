"""The reference jobs' own inputs and outputs, re-run through the operators."""

import math
import statistics

from pyspark.sql import functions as F

from tests import fixtures as X
from tidepool.functions import render
from tidepool.functions.parse import ALARMED_LINE, LOST_CARD_LINE, TXN_LINE, parse_lines, parse_sale_lines
from tidepool.functions.rowstats import row_summary
from tidepool.operators import changes, rolling, rules, split, text


def _lines(spark, lines):
    return spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "seq long, value string")


def test_word_count_whole_lines(spark):
    df = spark.createDataFrame([(w,) for w in X.WORDS], "line string")
    got = {r["word"]: r["n"] for r in text.word_count(df, "line", "N").collect()}
    assert got == X.WORDS_EXPECTED


def test_rolling_average_sales(spark):
    raw = _lines(spark, X.SALE_LINES)
    assert parse_sale_lines(raw).columns == ["month", "category", "product", "profit"]
    parsed = parse_lines(raw, [("date", "string"), ("month", "string"), ("category", "string"),
                               ("product", "string"), ("profit", "int")], keep=["seq"])
    out = rolling.rolling_avg(parsed, ["month"], ["seq"], "profit", n_chunks=2)
    got = [(r["month"], r["running_avg"]) for r in out.orderBy("seq").collect()]
    assert got == X.SALE_RUNNING_AVG


def test_rolling_reduce_keeps_first_fields(spark):
    raw = _lines(spark, X.SALE_LINES)
    parsed = raw.select("seq", F.split_part("value", F.lit(","), F.lit(2)).alias("month"),
                        F.split_part("value", F.lit(","), F.lit(4)).alias("product"),
                        F.split_part("value", F.lit(","), F.lit(5)).cast("int").alias("profit"))
    out = rolling.rolling_reduce(parsed, ["month"], ["seq"], "profit", firsts=["product"])
    rows = {r["seq"]: r for r in out.collect()}
    assert rows[4]["running_sum"] == 12 + 10 + 38 + 41 and rows[4]["running_count"] == 4
    assert rows[4]["first_product"] == "Bat" and rows[2]["first_product"] == "Television"


def test_split_even_odd(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(X.INTEGERS)], "seq long, value long")
    even = [r["value"] for r in split.split_even(df, "value", keep=["seq"]).orderBy("seq").collect()]
    odd = [r["value"] for r in split.split_odd(df, "value", keep=["seq"]).orderBy("seq").collect()]
    assert even == X.EVEN_EXPECTED and odd == X.ODD_EXPECTED
    neg = spark.createDataFrame([(-3,), (-4,)], "value long")
    assert [r[0] for r in split.split_odd(neg, "value").collect()] == [-3]


def test_fraud_membership_rules(spark):
    txns = parse_lines(_lines(spark, X.TXN_LINES), TXN_LINE, keep=["seq"])
    alarmed = parse_lines(_lines(spark, X.ALARMED_LINES), ALARMED_LINE)
    lost = parse_lines(_lines(spark, X.LOST_CARD_LINES), LOST_CARD_LINE)
    cols = ["txn_id", "customer_id", "card_id", "city"]
    a = rules.flag_members(txns, "customer_id", alarmed, "customer_id", rules.RULE_ALARMED, cols)
    lc = rules.flag_members(txns, "card_id", lost, "card_id", rules.RULE_LOST_CARD, cols)
    assert {r["txn_id"] for r in a.collect()} == X.ALARMED_TXN_IDS
    assert {r["txn_id"] for r in lc.collect()} == X.LOST_TXN_IDS
    both = rules.union_alerts(a, lc)
    assert both.count() == len(X.ALARMED_TXN_IDS) + len(X.LOST_TXN_IDS)


def test_city_change_rule_on_fixture(spark):
    txns = parse_lines(_lines(spark, X.TXN_LINES), TXN_LINE, keep=["seq"])
    out = changes.frequent_change(txns, ["customer_id"], ["seq"], "city", 2)
    # id_347hfx: Chandigarh -> Surat -> Ahemdabad (2nd change on its 3rd txn)
    # id_158gsb: Ludhiana -> Surat -> Surat (1 change only)
    got = {(r["customer_id"], r["txn_id"], r["n_changes"]) for r in out.collect()}
    assert got == {("id_347hfx", "JYKS920766", 2)}


def test_minute_report_and_delta_alert(spark):
    # one tick at the window's first and last second carrying its max and min
    ticks = []
    for i, line in enumerate(X.MINUTE_REPORT):
        span, mx, mn, _, vmx, vmn, _ = [s.strip() for s in line.split(",")]
        start, end = [s.strip() for s in span.split(" - ")]
        ticks.append((2 * i, start, float(mx), int(vmn)))
        ticks.append((2 * i + 1, end, float(mn), int(vmx)))
    df = spark.createDataFrame(ticks, "seq long, stamp string, price double, volume int") \
        .withColumn("ts", F.to_timestamp("stamp", "dd/MM/yyyy:HH:mm:ss"))
    rep = changes.window_change(df, "ts", "1 minute", [], "price", "volume", ["ts", "seq"])
    fmt = "dd/MM/yyyy:HH:mm:ss"
    lines = rep.orderBy("window_start").select(render.window_report(
        F.date_format("first_ts", fmt), F.date_format("last_ts", fmt), "max_price", "min_price",
        "max_price_change", "max_volume", "min_volume", "max_volume_change").alias("l")).collect()
    assert [r["l"] for r in lines] == X.MINUTE_REPORT
    alert = spark.range(1).select(render.delta_alert(
        F.lit(((106.0 - 115.0) / 115.0) * 100), F.lit(115.0), F.lit(106.0),
        F.lit("06/10/2010:09:20:00"))).first()[0]
    assert alert == X.DELTA_ALERT


def test_large_delta_first_window_never_alerts(spark):
    rows = [(0, "2024-01-01 00:00:10", 100.0), (1, "2024-01-01 00:05:10", 120.0),
            (2, "2024-01-01 00:10:10", 121.0), (3, "2024-01-01 00:15:10", 90.0)]
    df = spark.createDataFrame(rows, "seq long, t string, price double") \
        .withColumn("ts", F.to_timestamp("t")).withColumn("sym", F.lit("XYZ"))
    out = changes.large_delta(df, "ts", "5 minutes", ["sym"], "price", ["ts", "seq"], 5.0)
    got = sorted((r["prev_max"], r["cur_max"]) for r in out.collect())
    assert got == [(100.0, 120.0), (121.0, 90.0)]


def test_row_stats_matches_statistics_module(spark):
    data = [("LNK", 10000, 12300, 9600, 13200), ("NWK", 2100, 2500, 2250, 2700)]
    df = spark.createDataFrame(data, "seller_id string, q1 int, q2 int, q3 int, q4 int")
    got = {r["seller_id"]: r for r in df.select(*row_summary("seller_id", ["q1", "q2", "q3", "q4"])).collect()}
    for sid, *qs in data:
        assert got[sid]["total"] == sum(qs)
        assert math.isclose(got[sid]["mean"], round(statistics.mean(qs), 2))
        assert math.isclose(got[sid]["stdev"], round(statistics.stdev(qs), 2), abs_tol=0.011)


def test_row_summary_udf_agrees_with_native(spark):
    from tidepool.functions.rowstats import row_summary_udf
    data = [("LNK", 10000, 12300, 9600, 13200), ("NWK", 2100, 2500, 2250, 2700)]
    df = spark.createDataFrame(data, "seller_id string, q1 int, q2 int, q3 int, q4 int")
    qs = ["q1", "q2", "q3", "q4"]
    udf_rows = {r["seller_id"]: r["s"] for r in df.select("seller_id", row_summary_udf(qs).alias("s")).collect()}
    nat = {r["seller_id"]: r for r in df.select(*row_summary("seller_id", qs)).collect()}
    for sid in nat:
        assert udf_rows[sid]["total"] == nat[sid]["total"]
        assert math.isclose(udf_rows[sid]["mean"], nat[sid]["mean"])
        assert math.isclose(round(udf_rows[sid]["stdev"], 2), nat[sid]["stdev"])


def test_alert_lines_match_flagged_output(spark):
    raw = _lines(spark, X.TXN_LINES)
    txns = parse_lines(raw, TXN_LINE, keep=["seq", "value"])
    alarmed = parse_lines(_lines(spark, X.ALARMED_LINES), ALARMED_LINE)
    lost = parse_lines(_lines(spark, X.LOST_CARD_LINES), LOST_CARD_LINE)
    cols = ["txn_id", "customer_id", "value"]
    a = rules.flag_members(txns, "customer_id", alarmed, "customer_id", rules.RULE_ALARMED, cols) \
        .select(render.alert_line(rules.RULE_ALARMED, "customer_id", "value").alias("l"))
    lc = rules.flag_members(txns, "card_id", lost, "card_id", rules.RULE_LOST_CARD, cols) \
        .select(render.alert_line(rules.RULE_LOST_CARD, "customer_id", "value").alias("l"))
    got = {r["l"] for r in a.union(lc).collect()}
    assert set(X.FLAGGED_LINES) <= got
    city = spark.createDataFrame([("id_741yce", X.CITY_CHANGE_LINE.split(",(", 1)[1].split(",", 1)[1]
                                   .rsplit(")marked", 1)[0])], "k string, line string")
    assert city.select(render.alert_line(rules.RULE_CITY_CHANGE, "k", "line")).first()[0] == X.CITY_CHANGE_LINE


def test_first_row_and_arg_max_tie_breaks(spark):
    from tidepool.operators import windows
    rows = [(5, "2024-01-01 00:00:10", "u1", 3.0), (2, "2024-01-01 00:00:10", "u2", 7.0),
            (9, "2024-01-01 00:00:20", "u3", 7.0), (1, "2024-01-01 00:00:30", "u4", 1.0)]
    df = spark.createDataFrame(rows, "id long, t string, who string, price double") \
        .withColumn("ts", F.col("t").cast("timestamp_ntz")).withColumn("k", F.lit("x"))
    red = windows.window_reduce(df, "ts", "1 minute", ["k"], "price", ["ts", "id"],
                                first_cols=["id", "who"]).first()
    assert (red["first_id"], red["first_who"], red["n"]) == (2, "u2", 4)   # equal ts: smaller id
    later = df.withColumn("ts", F.col("ts") + F.expr("interval 1 minute")).withColumn("price", F.col("price") * 2)
    out = changes.large_delta(df.unionByName(later), "ts", "1 minute", ["k"], "price", ["ts", "id"], 5.0).first()
    assert out["prev_max"] == 7.0 and out["cur_max"] == 14.0
    assert str(out["max_ts"]) == "2024-01-01 00:01:10"                     # equal maxima: earliest
