"""Query catalogue: the reference jobs' computations over the stored tables.

Substitutions (tables have no arrival order, so every ordered operator gets
an explicit, unique order):

* transactions / ticks / sales -> ``events``: customer or seller =
  ``user_id``, city or symbol = ``event_type``, price = ``value``,
  volume / quantity = ``props.k``; order = ``(ts, event_id)``;
* cab trips -> ``orders`` (status 'F' = ongoing), order = ``o_orderkey``;
* text lines -> the lines of ``documents.text``.

Money is summed as ``decimal(12,2)`` (exact, so results do not depend on
summation order) and returned as double.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session as S
from ..functions import json as J
from ..functions.money import money
from ..functions.parse import (AMOUNT_LINE, CAB_LINE, LOST_CARD_LINE, SALE_LINE, TICK_LINE, key_by_field, parse_lines,
                               split_fields)
from ..functions.render import alert_line, window_report
from ..functions.rowstats import row_sample_stdev, row_total
from ..functions.time import millis_to_ts, ntz_micros, parse_ts
from ..operators import aggregates, changes, fold, rolling, rules, split, text, windows
from ..operators.joins import equi_join
from ..sinks.files import write_csv, write_text
from ..sources.files import csv_table, text_lines
from ..sources.tables import events, table

EVENT_ORDER = ["ts", "event_id"]
TXN_COLS = ["event_id", "ts", "user_id", "event_type", "value"]

# Window widths, thresholds and gaps of the catalogue.
REVENUE_WINDOW = "1 hour"
SLIDING_SIZE, SLIDING_SLIDE = "30 minutes", "10 minutes"
SESSION_GAP = "3 hours"
REDUCE_WINDOW = "1 day"
GLOBAL_WINDOW = "1 hour"
CHANGE_WINDOW = "6 hours"
DELTA_THRESHOLD = 5.0
ACTIVITY_WINDOW, ACTIVITY_THRESHOLD = "30 days", 40
CITY_WINDOW, CITY_MIN_CHANGES = "1 day", 2
DISTINCT_BELOW = 5.0
WATERMARK = "5 seconds"


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.configure(spark)
    return events(spark, sf_dir)


def _revenue(ev: DataFrame):
    return F.sum(money() * F.col("volume")).cast("double")


# -- windows ---------------------------------------------------------------

def tumbling_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    return windows.tumbling(ev, "ts", REVENUE_WINDOW, ["user_id"],
                            {"window_sales": _revenue(ev), "n_events": F.count(F.lit(1))})


def sliding_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    out = windows.sliding_sums(ev, "ts", SLIDING_SIZE, SLIDING_SLIDE, ["user_id"],
                               {"window_sales": money() * F.col("volume")}, "n_events")
    return out.withColumn("window_sales", F.col("window_sales").cast("double"))


def session_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    out = windows.session_sums(ev, "ts", SESSION_GAP, ["user_id"],
                               {"window_sales": money() * F.col("volume")}, "n_events")
    return out.withColumn("window_sales", F.col("window_sales").cast("double"))


def window_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    out = windows.window_reduce(ev, "ts", REDUCE_WINDOW, ["event_type"], money(), EVENT_ORDER,
                                first_cols=["event_id", "user_id"])
    return out.withColumn("total", F.col("total").cast("double"))


def window_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    return windows.global_window(ev, "ts", GLOBAL_WINDOW, {
        "total": F.sum(money()).cast("double"),
        "n": F.count(F.lit(1)),
        "first_ts": F.min("ts"),
    })


# -- rolling aggregates ---------------------------------------------------

def rolling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir).select("event_id", "ts", "event_type")
    return rolling.rolling_count(ev, ["event_type"], EVENT_ORDER)


def rolling_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir).select("event_id", "ts", "event_type", "user_id", "value")
    out = rolling.rolling_reduce(ev, ["event_type"], EVENT_ORDER, money(), firsts=["user_id"])
    return out.select("event_id", "ts", "event_type", F.col("running_sum").cast("double")
                      .alias("running_sum"), "running_count", "first_user_id")


def rolling_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    out = rolling.rolling_avg(ev, ["event_type"], EVENT_ORDER, money())
    return out.select("event_id", "ts", "event_type", "running_avg")


def _finished_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.configure(spark)
    return table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")


def trips_by_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _finished_orders(spark, sf_dir).select("o_orderkey", "o_orderpriority")
    return rolling.rolling_count(o, ["o_orderpriority"], ["o_orderkey"], name="trips")


def avg_by_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _finished_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    out = rolling.rolling_avg(o, ["o_custkey"], ["o_orderkey"], money("o_totalprice"),
                              name="avg_price")
    return out.select("o_orderkey", "o_custkey", "avg_price")


def ongoing_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.configure(spark)
    o = table(spark, sf_dir, "orders")
    return aggregates.ongoing(o, "o_orderstatus", "F", {"o_orderkey": "string", "o_custkey": "int"})


# -- text, split, parse, json ---------------------------------------------

def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.configure(spark)
    docs = table(spark, sf_dir, "documents")
    return text.word_count(text.lines(docs), "line", "N")


def split_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_even(table(spark, sf_dir, "orders"), "o_orderkey")


def split_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_odd(table(spark, sf_dir, "orders"), "o_orderkey")


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as sale lines ``dd-MM-yyyy,Month,category,product,profit``."""
    ev = _ev(spark, sf_dir)
    line = F.concat_ws(",", F.date_format("ts", "dd-MM-yyyy"), F.date_format("ts", "MMMM"),
                       F.col("event_type"), F.col("user_id").cast("string"),
                       F.col("volume").cast("string"))
    return ev.select("event_id", line.alias("value"))


def parse_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sale_lines(spark, sf_dir)
    return lines.select("event_id", *split_fields("value", SALE_LINE)).drop("sale_date")


def parse_cab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders rendered as cab lines and parsed; ongoing trips only, passengers cast after the filter."""
    o = table(spark, sf_dir, "orders")
    line = F.concat_ws(",", "o_orderkey", F.concat(F.lit("P"), "o_custkey"), F.lit("sedan"), "o_custkey",
                       F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no"), "o_orderpriority", "o_orderstatus",
                       F.when(F.col("o_orderstatus") == "F", F.month("o_orderdate").cast("string")).otherwise("none"))
    trips = parse_lines(o.select(line.alias("value")), CAB_LINE)
    return aggregates.ongoing(trips, "ongoing", "yes", {"passengers": "int"})


def parse_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as ``date,time,price,volume`` ticks, parsed, with the time of both text fields."""
    ev = _ev(spark, sf_dir)
    line = F.concat_ws(",", F.date_format("ts", "MM/dd/yyyy"), F.date_format("ts", "HH:mm:ss"), F.col("value").cast("string"),
                       F.col("volume").cast("string"))
    ticks = parse_lines(ev.select("event_id", line.alias("line")), TICK_LINE, "line", keep=["event_id"])
    at = parse_ts(F.concat_ws(" ", "date", "time"), "MM/dd/yyyy HH:mm:ss")
    return ticks.select("event_id", F.unix_seconds(at).alias("at_seconds"), "price", "volume")


def parse_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as ``ms,amount`` lines, parsed, with the event time of the milliseconds."""
    ev = _ev(spark, sf_dir)
    line = F.concat_ws(",", F.floor(ntz_micros("ts") / 1000).cast("string"), F.col("volume").cast("string"))
    rows = parse_lines(ev.select("event_id", line.alias("line")), AMOUNT_LINE, "line", keep=["event_id"])
    return rows.select("event_id", F.unix_millis(millis_to_ts("ts_ms")).alias("event_ms"), "amount")


def lines_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale lines counted by their product field."""
    keyed = key_by_field(sale_lines(spark, sf_dir), 3, "product")
    return keyed.groupBy("product").agg(F.count("*").alias("n_lines"))


def parse_lost_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers rendered as lost-card lines and parsed."""
    s = table(spark, sf_dir, "supplier")
    line = F.concat_ws(",", "s_suppkey", F.lit("2024-01-01"), "s_name",
                       F.when(F.col("s_acctbal") < 0, "lost").otherwise("held"))
    return parse_lines(s.select(line.alias("value")), LOST_CARD_LINE)


def alert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarmed customers' transactions as the alert lines that the job prints."""
    hits = flag_alarmed(spark, sf_dir)
    line = F.concat_ws(",", "event_id", "user_id", "event_type")
    return hits.select("event_id", alert_line(rules.RULE_ALARMED, "user_id", line).alias("alert"))


PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return J.decode(ev, PROPS_SCHEMA, "props", keep=["event_id"])


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window revenue as (key, JSON value) messages; money stays an exact decimal."""
    ev = _ev(spark, sf_dir)
    rev = windows.tumbling(ev, "ts", REVENUE_WINDOW, ["user_id"], {
        "window_sales": F.sum(money() * F.col("volume")).cast("decimal(18,2)")})
    return J.to_messages(rev.select("user_id", "window_start", "window_end", "window_sales"),
                         key_col="user_id", timestamp_format="yyyy-MM-dd HH:mm:ss")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as nested documents; every tenth is cut short and so not a document."""
    ev = table(spark, sf_dir, "events")
    doc = F.format_string('{"user": {"id": %d, "kind": "%s"}, "props": %s, "tags": ["%s", %d]}',
                          "user_id", "event_type", "props", "event_type", "event_id")
    cut = F.when(F.col("event_id") % 10 == 0, F.substr(doc, F.lit(1), F.length(doc) - 1)).otherwise(doc)
    return ev.select("event_id", J.parse_document(cut).alias("doc"))


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of schemaless documents by path; bad documents give nulls."""
    return _documents(spark, sf_dir).select(
        "event_id", J.document_field("doc", "$.user.id", "bigint").alias("user_id"),
        J.document_field("doc", "$.user.kind", "string").alias("kind"), J.document_field("doc", "$.props.k", "int").alias("k"),
        J.document_field("doc", "$.tags[1]", "bigint").alias("second_tag"),
        J.document_field("doc", "$.user.kind", "int").alias("kind_as_int"))


def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemaless documents as one row per top-level field; bad documents give none."""
    return J.explode_document(_documents(spark, sf_dir), "doc", ["event_id"])


# -- reduces with a merge of the user's own -----------------------------------

def _rise_state():
    """One event's share in the largest rise: lowest and highest value, and the rise from a low to a later high."""
    return F.struct(F.col("value").alias("low"), F.col("value").alias("high"), F.lit(0.0).alias("rise"))


def _merge_rise(a, b):
    return F.struct(F.least(a["low"], b["low"]).alias("low"), F.greatest(a["high"], b["high"]).alias("high"),
                    F.greatest(a["rise"], b["rise"], b["high"] - a["low"]).alias("rise"))


def rolling_rise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the largest rise of its type's value so far."""
    ev = _ev(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    out = fold.running_fold(ev, ["event_type"], EVENT_ORDER, _rise_state(), _merge_rise)
    return out.select("event_id", "ts", "event_type", F.col("state.rise").alias("rise"))


def window_rise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest rise of each event type's value per day."""
    ev = _ev(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    out = fold.window_fold(ev, "ts", REDUCE_WINDOW, ["event_type"], EVENT_ORDER, _rise_state(), _merge_rise)
    return out.select("event_type", "window_start", F.col("state.rise").alias("rise"), F.col("state.low").alias("low"))


# -- change detection ------------------------------------------------------

def window_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    return changes.window_change(ev, "ts", CHANGE_WINDOW, ["event_type"], "value", "volume",
                                 EVENT_ORDER)


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of every window as the line that the job writes, percent changes with two decimals."""
    at = "yyyy-MM-dd HH:mm:ss"
    line = window_report(F.date_format("first_ts", at), F.date_format("last_ts", at), "max_price", "min_price",
                         "max_price_change", "max_volume", "min_volume", "max_volume_change")
    return window_change(spark, sf_dir).select("event_type", "window_start", line.alias("line"))


def large_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    return changes.large_delta(ev, "ts", CHANGE_WINDOW, ["event_type"], "value", EVENT_ORDER,
                               DELTA_THRESHOLD)


def frequent_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir).select(*TXN_COLS)
    keyed = ev.withColumn("window_start", F.window("ts", CITY_WINDOW).start)
    out = changes.frequent_change(keyed, ["user_id", "window_start"], EVENT_ORDER, "event_type",
                                  CITY_MIN_CHANGES)
    return out.select("user_id", "window_start", "event_id", "ts", "event_type",
                      F.col("prev_city").alias("prev_event_type"), "n_changes")


# -- files ---------------------------------------------------------------------

def csv_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as a folder of CSV files, each with a header line, and read back with their types."""
    S.configure(spark)
    o = table(spark, sf_dir, "orders")
    folder = S.scratch_path(spark, "csv_folder")
    write_csv(o, folder, sep=";", header=True)
    return csv_table(spark, folder, o.schema, header=True, sep=";")


EVENT_LINE = [("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double")]


def event_lines(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Events written as text lines of their fields; returns the folder."""
    S.configure(spark)
    folder = S.scratch_path(spark, name)
    write_text(table(spark, sf_dir, "events"), folder, [n for n, _ in EVENT_LINE], wrap=None)
    return folder


def text_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of text lines read back into typed columns."""
    return parse_lines(text_lines(spark, event_lines(spark, sf_dir, "text_folder")), EVENT_LINE, strict=False)


# -- rules -------------------------------------------------------------------

def _txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ev(spark, sf_dir).select(*TXN_COLS)


def _alarmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)


def _lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0)


def flag_alarmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.flag_members(_txns(spark, sf_dir), "user_id", _alarmed(spark, sf_dir),
                              "c_custkey", rules.RULE_ALARMED, TXN_COLS)


def flag_lost_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.flag_members(_txns(spark, sf_dir), "user_id", _lost(spark, sf_dir),
                              "s_suppkey", rules.RULE_LOST_CARD, TXN_COLS)


def excessive_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.excessive_activity(_txns(spark, sf_dir), "user_id", "ts", ACTIVITY_WINDOW,
                                    EVENT_ORDER, TXN_COLS, ACTIVITY_THRESHOLD)


def city_change_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.city_changes(_txns(spark, sf_dir), "user_id", "ts", CITY_WINDOW, "event_type",
                              EVENT_ORDER, TXN_COLS, CITY_MIN_CHANGES)


def flagged_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four rules; both membership lists in one pass over the feed."""
    members = rules.flag_members_many(_txns(spark, sf_dir), [
        ("user_id", _alarmed(spark, sf_dir), "c_custkey", rules.RULE_ALARMED),
        ("user_id", _lost(spark, sf_dir), "s_suppkey", rules.RULE_LOST_CARD)], TXN_COLS)
    return rules.union_alerts(members, excessive_activity(spark, sf_dir),
                              city_change_alerts(spark, sf_dir))


# -- joins, counts, distinct, row statistics -------------------------------

def stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.configure(spark)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name",
                                                "c_mktsegment")
    return equi_join(o, c, "o_custkey")


def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.configure(spark)
    return aggregates.group_count(table(spark, sf_dir, "orders"), ["o_custkey"])


def distinct_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.configure(spark)
    ev = table(spark, sf_dir, "events")
    return aggregates.distinct_where(ev, ["user_id", "event_type"], F.col("value") < DISTINCT_BELOW)


def quarterly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders pivoted to one row per customer with sales per quarter, in cents."""
    o = table(spark, sf_dir, "orders")
    q = F.quarter("o_orderdate")
    units = (money("o_totalprice") * 100).cast("bigint")
    return o.groupBy(F.col("o_custkey").alias("seller_id")).agg(
        *[F.coalesce(F.sum(F.when(q == i, units)), F.lit(0)).alias(f"q{i}") for i in range(1, 5)])


def row_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.configure(spark)
    qs = quarterly_sales(spark, sf_dir)
    cents = ["q1", "q2", "q3", "q4"]
    # the mean is rounded half up on whole cents, so no binary fraction decides a tie
    mean = F.floor((row_total(cols=cents) * 2 + 4) / 8)
    return qs.select("seller_id", (row_total(cents) / 100.0).alias("total_sales"),
                     (mean / 100.0).alias("quarter_avg"),
                     F.round(row_sample_stdev(cents) / 100.0, 2).alias("quarter_stdev")).orderBy("seller_id")


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "tumbling_revenue": tumbling_revenue,
    "sliding_revenue": sliding_revenue,
    "session_revenue": session_revenue,
    "window_reduce": window_reduce,
    "window_global": window_global,
    "rolling_count": rolling_count,
    "rolling_reduce": rolling_reduce,
    "rolling_avg": rolling_avg,
    "trips_by_destination": trips_by_destination,
    "avg_by_pickup": avg_by_pickup,
    "ongoing_filter": ongoing_filter,
    "word_count": word_count,
    "split_even": split_even,
    "split_odd": split_odd,
    "parse_line": parse_line,
    "parse_cab": parse_cab,
    "parse_tick": parse_tick,
    "parse_amount": parse_amount,
    "parse_lost_card": parse_lost_card,
    "lines_by_field": lines_by_field,
    "alert_text": alert_text,
    "report_lines": report_lines,
    "csv_folder": csv_folder,
    "text_folder": text_folder,
    "json_decode": json_decode,
    "json_encode": json_encode,
    "json_documents": json_documents,
    "json_fields": json_fields,
    "rolling_rise": rolling_rise,
    "window_rise": window_rise,
    "window_change": window_change,
    "large_delta": large_delta,
    "frequent_change": frequent_change,
    "excessive_activity": excessive_activity,
    "flag_alarmed": flag_alarmed,
    "flag_lost_card": flag_lost_card,
    "city_change_alerts": city_change_alerts,
    "flagged_all": flagged_all,
    "stream_join": stream_join,
    "group_count": group_count,
    "distinct_where": distinct_where,
    "row_stats": row_stats,
}


def _sql_queries() -> dict:
    from .sql_windows import SQL_QUERIES
    return SQL_QUERIES


BATCH_QUERIES.update(_sql_queries())
