"""Streaming runs of catalogue queries over the ``events`` file, read back
from their Parquet sinks.

Append mode emits a window once the watermark (max event time - 5 s) has
passed its end, so the result holds the closed windows only; the oracle
applies the same cut.  ``availableNow`` processes the backlog in micro-batches
and closes with a no-data batch that advances the watermark.

Contract for disorder: rows of later micro-batches may be older than rows of
earlier ones by no more than the watermark delay.  A run in which any row was
dropped as late raises instead of returning a short result.  The per-record
queries (``stream_rolling_sums`` and the city changes of ``stream_alerts``) hold
rows back until the watermark has passed their ten minutes and write them in event
order; the first two take their table as a feed that has ended and bring the rows still
held then, and those without a time last.  A table whose part files are not split by time has to fit one
micro-batch (see the rate limits in ``runners``) or be given a longer delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session as S
from ..functions.time import instant_to_ntz, ntz_micros
from ..operators import rules, windows
from ..functions.parse import parse_lines
from ..operators.joins import equi_join, ttl_join
from ..plans.catalog import (ACTIVITY_THRESHOLD, ACTIVITY_WINDOW, CHANGE_WINDOW, CITY_MIN_CHANGES,
                             CITY_WINDOW, DELTA_THRESHOLD, DISTINCT_BELOW,
                             EVENT_LINE, EVENT_ORDER, REVENUE_WINDOW, SESSION_GAP, SLIDING_SIZE,
                             SLIDING_SLIDE, TXN_COLS, WATERMARK, _alarmed, _lost, event_lines, money)
from ..plans.oracle import ORACLE_SQL
from ..sources.files import text_lines
from ..sources.tables import table
from .changelog import count_changes, current, distinct_changes, run_to_changelog
from .operators import flag_members_refreshed
from .ordered import activity_step, city_step, hold, member_step, rolling_step, run_in_order
from .runners import event_stream, read_back, run_to_parquet, use_rocksdb_state, with_event_columns
from .stateful import PreviousWindowDelta, WindowReport


JOIN_WITHIN = "1 hour"
JOIN_TTL = "1 day"
LATE_PARTS = 3  # runs that bring the feed of stream_late_rows


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    S.configure(spark)
    use_rocksdb_state(spark)
    return event_stream(spark, sf_dir).withWatermark("evt", WATERMARK)


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``_stream`` as a table."""
    return with_event_columns(table(spark, sf_dir, "events"))


def _ntz_bounds(df: DataFrame, keys: list[str], rest: list[str]) -> DataFrame:
    return df.select(*keys, instant_to_ntz("window_start").alias("window_start"),
                     instant_to_ntz("window_end").alias("window_end"), *rest)


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _stream(spark, sf_dir)
    agg = windows.tumbling(ev, "evt", REVENUE_WINDOW, ["user_id"], {
        "window_sales": F.sum(money() * F.col("volume")).cast("double"),
        "n_events": F.count(F.lit(1))})
    out = run_to_parquet(agg, "stream_tumbling", "append", fail_on_late=True)
    return _ntz_bounds(read_back(spark, out), ["user_id"], ["window_sales", "n_events"])


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _stream(spark, sf_dir)
    agg = windows.sliding_sums(ev, "evt", SLIDING_SIZE, SLIDING_SLIDE, ["user_id"],
                               {"window_sales": money() * F.col("volume")}, "n_events")
    out = run_to_parquet(agg.withColumn("window_sales", F.col("window_sales").cast("double")), "stream_sliding", "append", fail_on_late=True)
    return _ntz_bounds(read_back(spark, out), ["user_id"], ["window_sales", "n_events"])


def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _stream(spark, sf_dir)
    agg = windows.session(ev, "evt", SESSION_GAP, ["user_id"], {
        "window_sales": F.sum(money() * F.col("volume")).cast("double"),
        "n_events": F.count(F.lit(1))})
    out = run_to_parquet(agg, "stream_session", "append", fail_on_late=True)
    return _ntz_bounds(read_back(spark, out), ["user_id"], ["window_sales", "n_events"])


DELTA_OUT = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("prev_max", T.DoubleType()),
    T.StructField("cur_max", T.DoubleType()),
    T.StructField("pct_change", T.DoubleType()),
    T.StructField("max_ts", T.TimestampNTZType()),
])


def stream_large_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window maxima per event type (append mode), then a stateful processor
    compares each closed window with the key's previous one."""
    use_rocksdb_state(spark)
    ev = _stream(spark, sf_dir)
    arg_key = F.struct((-F.col("value")).alias("neg"), *[F.col(c) for c in EVENT_ORDER])
    per_window = windows.tumbling(ev, "evt", CHANGE_WINDOW, ["event_type"], {
        "cur_max": F.greatest(F.max("value"), F.lit(0.0)),
        "max_ts": F.min_by(F.col("ts"), arg_key)})
    alerts = per_window.groupBy("event_type").transformWithStateInPandas(
        statefulProcessor=PreviousWindowDelta("event_type", DELTA_THRESHOLD),
        outputStructType=DELTA_OUT, outputMode="Append", timeMode="None")
    out = run_to_parquet(alerts, "stream_large_delta", "append", fail_on_late=True)
    return _ntz_bounds(read_back(spark, out, DELTA_OUT), ["event_type"],
                       ["prev_max", "cur_max", "pct_change", "max_ts"])


REPORT_COLS = ["event_type", "window_start", "window_end", "max_price", "min_price", "max_volume",
               "min_volume", "first_ts", "last_ts"]


def stream_window_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-window report on a stream: window stats (append mode), then a
    stateful processor adds the percent change of both maxima against the
    key's previous window."""
    ev = _stream(spark, sf_dir)
    stats = windows.tumbling(ev, "evt", CHANGE_WINDOW, ["event_type"], {
        "max_price": F.greatest(F.max("value"), F.lit(0.0)),
        "min_price": F.min("value"),
        "max_volume": F.greatest(F.max("volume"), F.lit(0)),
        "min_volume": F.min("volume"),
        "first_ts": F.min("ts"),
        "last_ts": F.max("ts")})
    schema = T.StructType([
        T.StructField("event_type", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("max_price", T.DoubleType()), T.StructField("min_price", T.DoubleType()),
        T.StructField("max_volume", T.IntegerType()), T.StructField("min_volume", T.IntegerType()),
        T.StructField("first_ts", T.TimestampNTZType()), T.StructField("last_ts", T.TimestampNTZType()),
        T.StructField("max_price_change", T.DoubleType()),
        T.StructField("max_volume_change", T.DoubleType())])
    report = stats.groupBy("event_type").transformWithStateInPandas(
        statefulProcessor=WindowReport(REPORT_COLS), outputStructType=schema,
        outputMode="Append", timeMode="None")
    out = run_to_parquet(report, "stream_window_change", "append", fail_on_late=True)
    return _ntz_bounds(read_back(spark, out, schema), ["event_type"],
                       [c for c in schema.fieldNames() if c not in ("event_type", "window_start", "window_end")])


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four rules on a stream: membership (stateless; the lists are read
    again for every micro-batch), and over one more read of the feed, in event
    order, the windowed activity rule (emitted when its window closes) and the
    city-change rule (emitted per transaction)."""
    def lists(session: SparkSession):
        return [("user_id", _alarmed(session, sf_dir), "c_custkey", rules.RULE_ALARMED),
                ("user_id", _lost(session, sf_dir), "s_suppkey", rules.RULE_LOST_CARD)]

    members = flag_members_refreshed(event_stream(spark, sf_dir).select(*TXN_COLS), lists, TXN_COLS)
    def txns(events: DataFrame) -> DataFrame:
        return events.select(*TXN_COLS, "evt")

    alerts = run_in_order(hold(txns(_stream(spark, sf_dir)), "evt", EVENT_ORDER), "stream_alerts", {
        "busy": activity_step("user_id", "evt", ACTIVITY_WINDOW, EVENT_ORDER, TXN_COLS, ACTIVITY_THRESHOLD),
        "moves": city_step("user_id", "evt", CITY_WINDOW, "event_type", EVENT_ORDER, TXN_COLS, CITY_MIN_CHANGES)},
        feed=txns(_feed(spark, sf_dir)), time_col="evt", delay=WATERMARK)

    def flagged(name: str, rule: str, n: str) -> DataFrame:
        return alerts[name].select(F.lit(rule).alias("rule"), *TXN_COLS,
                                   instant_to_ntz("window_start").alias("window_start"), F.col(n).cast("bigint").alias("n"))

    return rules.union_alerts(members, flagged("busy", rules.RULE_EXCESSIVE, "n"),
                              flagged("moves", rules.RULE_CITY_CHANGE, "n_changes"))


def stream_rolling_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-record running count and sum (in cents) per event type, in event order."""
    def cents(events: DataFrame) -> DataFrame:
        return events.select("event_type", *EVENT_ORDER, "evt", (money() * 100).cast("bigint").alias("cents"))

    out = run_in_order(hold(cents(_stream(spark, sf_dir)), "evt", EVENT_ORDER), "stream_rolling_sums",
                       {"sums": rolling_step(["event_type"], EVENT_ORDER, "cents")},
                       feed=cents(_feed(spark, sf_dir)), time_col="evt", delay=WATERMARK)
    return out["sums"].select("event_type", *EVENT_ORDER, "running_count", "running_sum")


def stream_event_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams joined on the user: purchases and errors at most ``JOIN_WITHIN`` apart."""
    S.configure(spark)
    use_rocksdb_state(spark)

    def of(kind: str, prefix: str) -> DataFrame:
        return event_stream(spark, sf_dir).where(F.col("event_type") == kind).select(
            "user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"),
            F.col("evt").alias(f"{prefix}_evt"))

    joined = equi_join(of("purchase", "purchase"), of("error", "error"), "user_id", left_time="purchase_evt",
                       right_time="error_evt", watermark=WATERMARK, within=JOIN_WITHIN)
    out = run_to_parquet(joined.select("user_id", "purchase_id", "error_id", "purchase_ts", "error_ts"),
                         "stream_event_join", fail_on_late=True)
    return read_back(spark, out)


def stream_regular_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams joined on the user without a time bound: every signup with every purchase.

    Both sides stay in the join's state for good, as the regular join that it stands for keeps them."""
    S.configure(spark)
    use_rocksdb_state(spark)

    def of(kind: str, prefix: str) -> DataFrame:
        return event_stream(spark, sf_dir).where(F.col("event_type") == kind).select(
            "user_id", F.col("event_id").alias(f"{prefix}_id"))

    joined = equi_join(of("signup", "signup"), of("purchase", "purchase"), "user_id")
    return read_back(spark, run_to_parquet(joined, "stream_regular_join"))


def stream_ttl_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regular join with a state that forgets: every click with every error of its user that arrives
    within ``JOIN_TTL``; the run is far shorter, so these are all of them."""
    S.configure(spark)
    use_rocksdb_state(spark)

    def of(kind: str, prefix: str) -> DataFrame:
        return event_stream(spark, sf_dir).where(F.col("event_type") == kind).select(
            "user_id", F.col("event_id").alias(f"{prefix}_id"))

    joined = ttl_join(of("click", "click"), of("error", "error"), "user_id", JOIN_TTL)
    return read_back(spark, run_to_parquet(joined, "stream_ttl_join", fail_on_late=True))


def stream_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of text lines as a stream, parsed into typed columns."""
    lines = text_lines(spark, event_lines(spark, sf_dir, "stream_text_lines"), streaming=True)
    rows = parse_lines(lines, EVENT_LINE, strict=False)
    return read_back(spark, run_to_parquet(rows, "stream_text_lines_out"), rows.schema)


def stream_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous count per user: the latest version of every key of the changelog."""
    S.configure(spark)
    use_rocksdb_state(spark)
    counts = count_changes(event_stream(spark, sf_dir), ["user_id"])
    return current(spark, run_to_changelog(counts, "stream_group_count"), ["user_id"])


def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous distinct (user, event type) of small events; a key's state expires with the watermark."""
    keys = ["user_id", "event_type"]
    rows = _stream(spark, sf_dir).where(F.col("value") < DISTINCT_BELOW).select(*keys, "evt")
    out = run_to_changelog(distinct_changes(rows, keys), "stream_distinct", "append")
    return current(spark, out, keys).select(*keys)


def stream_member_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarmed users' events, where the list changes with the stream: an error puts its user on the list,
    a signup takes the user off, both from the next event on.  The list starts as the customers in debt."""
    update = F.when(F.col("event_type") == "error", True).when(F.col("event_type") == "signup", False)
    rows = hold(_stream(spark, sf_dir).select(*TXN_COLS, "evt", update.alias("on_list")), "evt", EVENT_ORDER)
    found = run_in_order(rows, "stream_member_updates", {"members": member_step(
        "user_id", EVENT_ORDER, "on_list", TXN_COLS, _alarmed(spark, sf_dir), "c_custkey")})
    return found["members"].select(*TXN_COLS)


def _late_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the ``part`` of the feed that brings them: thirds of the time span, every tenth event one part late."""
    ev = table(spark, sf_dir, "events").where(F.col("ts").isNotNull())
    micros = ntz_micros(F.col("ts"))
    first, last = ev.agg(F.min(micros), F.max(micros)).first()
    span = 1 if first is None else last - first + 1
    third = F.least(F.expr(f"(_us - {first or 0}) * {LATE_PARTS} div {span}"), F.lit(LATE_PARTS - 1))
    late = (F.col("event_id") % 10 == 0) & (third < LATE_PARTS - 1)
    return ev.withColumn("_us", micros).withColumn("part", third + late.cast("int")).drop("_us")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts per event type over a feed that comes in three runs, a tenth of each run's rows one run late.

    Late rows whose hour the watermark of the runs before has passed are dropped, the others count."""
    S.configure(spark)
    use_rocksdb_state(spark)
    feed, src, out = _late_feed(spark, sf_dir), S.scratch_path(spark, "late-feed"), S.scratch_path(spark, "stream_late_rows")
    for part in range(LATE_PARTS):
        feed.where(F.col("part") == part).drop("part").write.mode("append").parquet(src)
        ev = event_stream(spark, src, "*.parquet").withWatermark("evt", WATERMARK)
        counts = windows.tumbling(ev, "evt", REVENUE_WINDOW, ["event_type"], {"n_events": F.count(F.lit(1))})
        run_to_parquet(counts, "stream_late_rows", "append", path=out)
    return _ntz_bounds(read_back(spark, out, counts.schema), ["event_type"], ["n_events"])


def _closed(sql: str, end_col: str = "window_end") -> str:
    return (f"SELECT * FROM ({sql}) WHERE {end_col} <= "
            f"(SELECT MAX(ts) FROM events) - INTERVAL '5 seconds'")


# rows whose ten minutes the final watermark has passed
RELEASED = "time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' <= (SELECT MAX(ts) FROM events) - INTERVAL '5 seconds'"

STREAM_QUERIES = {
    "stream_tumbling": stream_tumbling,
    "stream_sliding": stream_sliding,
    "stream_session": stream_session,
    "stream_large_delta": stream_large_delta,
    "stream_alerts": stream_alerts,
    "stream_window_change": stream_window_change,
    "stream_rolling_sums": stream_rolling_sums,
    "stream_event_join": stream_event_join,
    "stream_regular_join": stream_regular_join,
    "stream_ttl_join": stream_ttl_join,
    "stream_text_lines": stream_text_lines,
    "stream_group_count": stream_group_count,
    "stream_distinct": stream_distinct,
    "stream_member_updates": stream_member_updates,
    "stream_late_rows": stream_late_rows,
}

STREAM_ORACLE_SQL = {
    "stream_window_change": _closed(ORACLE_SQL["window_change"]),
    "stream_tumbling": _closed(ORACLE_SQL["tumbling_revenue"]),
    "stream_sliding": _closed(ORACLE_SQL["sliding_revenue"]),
    "stream_session": _closed(ORACLE_SQL["session_revenue"]),
    "stream_large_delta": _closed(ORACLE_SQL["large_delta"]),
    "stream_alerts": (f"{ORACLE_SQL['flag_alarmed']} UNION ALL {ORACLE_SQL['flag_lost_card']} UNION ALL "
                      f"SELECT * FROM ({ORACLE_SQL['excessive_activity']}) WHERE window_start + "
                      f"INTERVAL '30 days' <= (SELECT MAX(ts) FROM events) - INTERVAL '5 seconds' "
                      f"UNION ALL {ORACLE_SQL['city_change_alerts']}"),
    "stream_rolling_sums": (f"SELECT event_id, ts, event_type, running_count, CAST(round(running_sum * 100) AS BIGINT) "
                            f"AS running_sum FROM ({ORACLE_SQL['rolling_reduce']})"),
    "stream_event_join": """
        SELECT p.user_id, p.event_id AS purchase_id, e.event_id AS error_id, p.ts AS purchase_ts, e.ts AS error_ts
        FROM events p JOIN events e ON p.user_id = e.user_id
        WHERE p.event_type = 'purchase' AND e.event_type = 'error'
          AND e.ts BETWEEN p.ts - INTERVAL '1 hour' AND p.ts + INTERVAL '1 hour'""",
    "stream_regular_join": """
        SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id FROM events s JOIN events p ON s.user_id = p.user_id
        WHERE s.event_type = 'signup' AND p.event_type = 'purchase'""",
    "stream_ttl_join": """
        SELECT c.user_id, c.event_id AS click_id, e.event_id AS error_id FROM events c JOIN events e ON c.user_id = e.user_id
        WHERE c.event_type = 'click' AND e.event_type = 'error'""",
    "stream_text_lines": ORACLE_SQL["text_folder"],
    "stream_group_count": "SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id",
    "stream_distinct": ORACLE_SQL["distinct_where"],
    "stream_member_updates": f"""
        SELECT event_id, ts, user_id, event_type, value FROM (
            SELECT *, LAST_VALUE(on_list IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
            FROM (SELECT *, CASE event_type WHEN 'error' THEN TRUE WHEN 'signup' THEN FALSE END AS on_list FROM events))
        WHERE on_list IS NULL AND {RELEASED}
          AND COALESCE(before, user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))""",
    "stream_late_rows": f"""
        WITH span AS (SELECT epoch_us(MIN(ts)) AS first, epoch_us(MAX(ts)) - epoch_us(MIN(ts)) + 1 AS width FROM events),
        thirds AS (SELECT event_id, ts, event_type, (epoch_us(ts) - first) * {LATE_PARTS} // width AS third FROM events, span),
        fed AS (SELECT *, third + CASE WHEN event_id % 10 = 0 AND third < {LATE_PARTS - 1} THEN 1 ELSE 0 END AS part,
                       time_bucket(INTERVAL '1 hour', ts) AS window_start FROM thirds),
        marks AS (SELECT p.part, MAX(f.ts) - INTERVAL '5 seconds' AS mark
                  FROM (SELECT DISTINCT part FROM fed) p JOIN fed f ON f.part < p.part GROUP BY p.part)
        SELECT event_type, window_start, window_start + INTERVAL '1 hour' AS window_end, COUNT(*) AS n_events
        FROM fed LEFT JOIN marks USING (part)
        WHERE (mark IS NULL OR window_start + INTERVAL '1 hour' > mark)
          AND window_start + INTERVAL '1 hour' <= (SELECT MAX(ts) FROM events) - INTERVAL '5 seconds'
        GROUP BY event_type, window_start""",
}
