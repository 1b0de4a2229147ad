"""Independent DuckDB SQL for every catalogue query (same column names).

Written directly from the query definitions in :mod:`tidepool.plans.catalog`
with plain window functions and GROUP BY, no chunking: the point is to check
the distributed plans against the obvious formulation.
"""

from __future__ import annotations

VOL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
# the stored digits, whatever their number: nothing is rounded to cents here
MONEY = "CAST(CAST(value AS VARCHAR) AS DECIMAL(18,6))"
EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def bucket(width: str, col: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{width}', {col}, {EPOCH})"


REVENUE = f"CAST(SUM({MONEY} * {VOL}) AS DOUBLE)"
EV_W = "PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

_TUMBLING = f"""
SELECT user_id, {bucket('1 hour')} AS window_start, {bucket('1 hour')} + INTERVAL '1 hour' AS window_end,
       {REVENUE} AS window_sales, COUNT(*) AS n_events
FROM events GROUP BY 1, 2, 3
"""

_SLIDING = f"""
WITH w AS (
  SELECT e.*, {bucket('10 minutes')} - INTERVAL (10 * r.k) MINUTE AS window_start
  FROM events e, range(0, 3) r(k))
SELECT user_id, window_start, window_start + INTERVAL '30 minutes' AS window_end,
       {REVENUE} AS window_sales, COUNT(*) AS n_events
FROM w GROUP BY 1, 2, 3
"""

_SESSION = f"""
WITH s AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '3 hours'
                 THEN 0 ELSE 1 END AS new_session
  FROM events),
g AS (
  SELECT *, SUM(new_session) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM s)
SELECT user_id, MIN(ts) AS window_start, MAX(ts) + INTERVAL '3 hours' AS window_end,
       {REVENUE} AS window_sales, COUNT(*) AS n_events
FROM g GROUP BY user_id, sid
"""

_WINDOW_REDUCE = f"""
SELECT event_type, {bucket('1 day')} AS window_start, {bucket('1 day')} + INTERVAL '1 day' AS window_end,
       CAST(SUM({MONEY}) AS DOUBLE) AS total, COUNT(*) AS n,
       arg_min(event_id, (ts, event_id)) AS first_event_id, arg_min(user_id, (ts, event_id)) AS first_user_id
FROM events GROUP BY 1, 2, 3
"""

_WINDOW_GLOBAL = f"""
SELECT {bucket('1 hour')} AS window_start, {bucket('1 hour')} + INTERVAL '1 hour' AS window_end,
       CAST(SUM({MONEY}) AS DOUBLE) AS total, COUNT(*) AS n, MIN(ts) AS first_ts
FROM events GROUP BY 1, 2
"""

_ROLLING_COUNT = f"""
SELECT event_id, ts, event_type, COUNT(*) OVER ({EV_W}) AS running_count FROM events
"""

_ROLLING_REDUCE = f"""
SELECT event_id, ts, event_type, CAST(SUM({MONEY}) OVER ({EV_W}) AS DOUBLE) AS running_sum,
       COUNT(*) OVER ({EV_W}) AS running_count, first_value(user_id) OVER ({EV_W}) AS first_user_id
FROM events
"""

_ROLLING_AVG = f"""
SELECT event_id, ts, event_type,
       CAST(SUM({MONEY}) OVER ({EV_W}) AS DOUBLE) / CAST(COUNT(*) OVER ({EV_W}) AS DOUBLE) AS running_avg
FROM events
"""

_TRIPS = """
SELECT o_orderkey, o_orderpriority,
       COUNT(*) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS trips
FROM orders WHERE o_orderstatus = 'F'
"""

_AVG_PICKUP = """
SELECT o_orderkey, o_custkey,
       CAST(SUM(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18,6))) OVER w AS DOUBLE) / CAST(COUNT(*) OVER w AS DOUBLE) AS avg_price
FROM orders WHERE o_orderstatus = 'F'
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

_ONGOING = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderstatus = 'F'
"""

_WORD_COUNT = """
SELECT line AS word, COUNT(*) AS n
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE starts_with(line, 'N') GROUP BY 1
"""

_SPLIT_EVEN = "SELECT CAST(o_orderkey AS VARCHAR) AS value FROM orders WHERE o_orderkey % 2 = 0"
_SPLIT_ODD = "SELECT o_orderkey AS value FROM orders WHERE o_orderkey % 2 <> 0"

_PARSE_LINE = f"""
SELECT event_id, strftime(ts, '%B') AS month, event_type AS category,
       CAST(user_id AS VARCHAR) AS product, {VOL} AS profit
FROM events
"""

_PARSE_CAB = """
SELECT CAST(o_orderkey AS VARCHAR) AS cab_id, 'P' || o_custkey AS plate, 'sedan' AS cab_type,
       CAST(o_custkey AS VARCHAR) AS driver, 'yes' AS ongoing, o_orderpriority AS pickup, o_orderstatus AS destination,
       CAST(month(o_orderdate) AS INTEGER) AS passengers
FROM orders WHERE o_orderstatus = 'F'
"""

_PARSE_TICK = f"""
SELECT event_id, CAST(epoch_us(date_trunc('second', ts)) // 1000000 AS BIGINT) AS at_seconds, value AS price, {VOL} AS volume
FROM events
"""

# epoch_ms() rounds; a millisecond counts once it is over
_PARSE_AMOUNT = f"SELECT event_id, epoch_us(ts) // 1000 AS event_ms, CAST({VOL} AS BIGINT) AS amount FROM events"

_PARSE_LOST = """
SELECT CAST(s_suppkey AS VARCHAR) AS card_id, '2024-01-01' AS reported_ts, s_name AS name,
       CASE WHEN s_acctbal < 0 THEN 'lost' ELSE 'held' END AS status
FROM supplier
"""

_LINES_BY_FIELD = "SELECT CAST(user_id AS VARCHAR) AS product, count(*) AS n_lines FROM events GROUP BY user_id"

_ALERT_TEXT = """
SELECT event_id, '(____ALARM___,Transaction: (' || user_id || ',' || event_id || ',' || user_id || ',' || event_type
       || ') is by an ALARMED customer)' AS alert
FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
"""

_JSON_DECODE = f"SELECT event_id, {VOL} AS k FROM events"

_JSON_ENCODE = f"""
SELECT CAST(user_id AS VARCHAR) AS key,
       to_json({{'user_id': user_id, 'window_start': strftime(window_start, '%Y-%m-%d %H:%M:%S'),
                 'window_end': strftime(window_end, '%Y-%m-%d %H:%M:%S'),
                 'window_sales': window_sales_dec}}) AS value
FROM (SELECT user_id, window_start, window_end,
             CAST(SUM({MONEY} * {VOL}) AS DECIMAL(18,2)) AS window_sales_dec
      FROM (SELECT *, {bucket('1 hour')} AS window_start, {bucket('1 hour')} + INTERVAL '1 hour' AS window_end
            FROM events) GROUP BY 1, 2, 3)
"""

_WINDOW_STATS = f"""
SELECT event_type, {bucket('6 hours')} AS window_start, {bucket('6 hours')} + INTERVAL '6 hours' AS window_end,
       greatest(MAX(value), 0.0) AS max_price, MIN(value) AS min_price,
       greatest(MAX(vol), 0) AS max_volume, MIN(vol) AS min_volume,
       MIN(ts) AS first_ts, MAX(ts) AS last_ts
FROM (SELECT *, {VOL} AS vol FROM events) GROUP BY 1, 2, 3
"""

_WINDOW_CHANGE = f"""
WITH s AS ({_WINDOW_STATS}),
l AS (SELECT *, lag(max_price) OVER w AS pp, lag(max_volume) OVER w AS pv FROM s
      WINDOW w AS (PARTITION BY event_type ORDER BY window_start))
SELECT event_type, window_start, window_end, max_price, min_price, max_volume, min_volume, first_ts, last_ts,
       CASE WHEN pp IS NULL OR pp = 0 THEN 0.0 ELSE (CAST(max_price - pp AS DOUBLE) / pp) * 100.0 END
         AS max_price_change,
       CASE WHEN pv IS NULL OR pv = 0 THEN 0.0 ELSE (CAST(max_volume - pv AS DOUBLE) / pv) * 100.0 END
         AS max_volume_change
FROM l
"""

def _two_decimals(x: str) -> str:
    """``x`` with two decimals, half up on its decimal digits; a small negative value keeps its sign."""
    rounded = f"CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)) AS DECIMAL(20, 2))"
    return f"CASE WHEN {x} < 0 AND {rounded} = 0 THEN '-0.00' ELSE CAST({rounded} AS VARCHAR) END"


_REPORT_LINES = f"""
SELECT event_type, window_start,
       strftime(first_ts, '%Y-%m-%d %H:%M:%S') || ' - ' || strftime(last_ts, '%Y-%m-%d %H:%M:%S') || ', ' ||
       CAST(max_price AS VARCHAR) || ', ' || CAST(min_price AS VARCHAR) || ', ' || {_two_decimals('max_price_change')} || ', ' ||
       CAST(max_volume AS VARCHAR) || ', ' || CAST(min_volume AS VARCHAR) || ', ' || {_two_decimals('max_volume_change')} AS line
FROM ({_WINDOW_CHANGE})
"""

_LARGE_DELTA = f"""
WITH w AS (
  SELECT event_type, {bucket('6 hours')} AS window_start, {bucket('6 hours')} + INTERVAL '6 hours' AS window_end,
         greatest(MAX(value), 0.0) AS cur_max, arg_min(ts, (-value, ts, event_id)) AS max_ts
  FROM events GROUP BY 1, 2, 3),
l AS (SELECT *, lag(cur_max) OVER (PARTITION BY event_type ORDER BY window_start) AS prev_max FROM w)
SELECT event_type, window_start, window_end, prev_max, cur_max,
       ((cur_max - prev_max) / prev_max) * 100.0 AS pct_change, max_ts
FROM l
WHERE prev_max IS NOT NULL AND prev_max <> 0 AND abs(((cur_max - prev_max) / prev_max) * 100.0) > 5.0
"""

_CITY_CHANGES = f"""
WITH k AS (
  SELECT event_id, ts, user_id, event_type, value, {bucket('1 day')} AS window_start,
         nullif(lower(event_type), '') AS v
  FROM events),
p AS (
  SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id, window_start ORDER BY ts, event_id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pv
  FROM k),
c AS (
  SELECT *, SUM(CASE WHEN v IS NOT NULL AND pv IS NOT NULL AND v <> pv THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id, window_start ORDER BY ts, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_changes
  FROM p)
SELECT * FROM c WHERE n_changes >= 2
"""

_FREQUENT_CHANGE = f"""
SELECT user_id, window_start, event_id, ts, event_type, pv AS prev_event_type,
       CAST(n_changes AS BIGINT) AS n_changes
FROM ({_CITY_CHANGES})
"""

_ALERT_NULLS = "CAST(NULL AS TIMESTAMP) AS window_start, CAST(1 AS BIGINT) AS n"

_FLAG_ALARMED = f"""
SELECT 'alarmed_customer' AS rule, event_id, ts, user_id, event_type, value, {_ALERT_NULLS}
FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
"""

_FLAG_LOST = f"""
SELECT 'lost_card' AS rule, event_id, ts, user_id, event_type, value, {_ALERT_NULLS}
FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
"""

_EXCESSIVE = f"""
SELECT 'excessive_activity' AS rule, arg_min(event_id, (ts, event_id)) AS event_id, MIN(ts) AS ts, user_id,
       arg_min(event_type, (ts, event_id)) AS event_type, arg_min(value, (ts, event_id)) AS value,
       {bucket('30 days')} AS window_start, COUNT(*) AS n
FROM events GROUP BY user_id, {bucket('30 days')} HAVING COUNT(*) > 40
"""

_CITY_ALERTS = f"""
SELECT 'frequent_city_change' AS rule, event_id, ts, user_id, event_type, value, window_start,
       CAST(n_changes AS BIGINT) AS n
FROM ({_CITY_CHANGES})
"""

_FLAGGED_ALL = f"""
{_FLAG_ALARMED} UNION ALL {_FLAG_LOST} UNION ALL {_EXCESSIVE} UNION ALL {_CITY_ALERTS}
"""

_STREAM_JOIN = """
SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey
"""

_GROUP_COUNT = "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1"

_DISTINCT_WHERE = "SELECT DISTINCT user_id, event_type FROM events WHERE value < 5.0"


def _q(i: int) -> str:
    return (f"COALESCE(SUM(CASE WHEN quarter(o_orderdate) = {i} "
            f"THEN CAST(round(o_totalprice * 100) AS BIGINT) END), 0)")


def _d(q: str) -> str:
    return f"(CAST({q} AS DOUBLE) - m)"


_ROW_STATS = f"""
WITH q AS (
  SELECT o_custkey AS seller_id, CAST({_q(1)} AS BIGINT) AS q1, CAST({_q(2)} AS BIGINT) AS q2,
         CAST({_q(3)} AS BIGINT) AS q3, CAST({_q(4)} AS BIGINT) AS q4
  FROM orders GROUP BY 1),
m AS (SELECT *, q1 + q2 + q3 + q4 AS total, CAST(q1 + q2 + q3 + q4 AS DOUBLE) / 4.0 AS m FROM q)
SELECT seller_id, total / 100.0 AS total_sales, ((2 * total + 4) // 8) / 100.0 AS quarter_avg,
       round(sqrt(({_d('q1')} * {_d('q1')} + {_d('q2')} * {_d('q2')} + {_d('q3')} * {_d('q3')}
                   + {_d('q4')} * {_d('q4')}) / 3.0) / 100.0, 2) AS quarter_stdev
FROM m ORDER BY seller_id
"""

ORACLE_SQL: dict[str, str] = {
    "tumbling_revenue": _TUMBLING,
    "sliding_revenue": _SLIDING,
    "session_revenue": _SESSION,
    "window_reduce": _WINDOW_REDUCE,
    "window_global": _WINDOW_GLOBAL,
    "rolling_count": _ROLLING_COUNT,
    "rolling_reduce": _ROLLING_REDUCE,
    "rolling_avg": _ROLLING_AVG,
    "trips_by_destination": _TRIPS,
    "avg_by_pickup": _AVG_PICKUP,
    "ongoing_filter": _ONGOING,
    "word_count": _WORD_COUNT,
    "split_even": _SPLIT_EVEN,
    "split_odd": _SPLIT_ODD,
    "parse_line": _PARSE_LINE,
    "parse_cab": _PARSE_CAB,
    "parse_tick": _PARSE_TICK,
    "parse_amount": _PARSE_AMOUNT,
    "parse_lost_card": _PARSE_LOST,
    "lines_by_field": _LINES_BY_FIELD,
    "alert_text": _ALERT_TEXT,
    "report_lines": _REPORT_LINES,
    "csv_folder": "SELECT * FROM orders",
    "text_folder": "SELECT event_id, user_id, event_type, value FROM events",
    "json_decode": _JSON_DECODE,
    "json_encode": _JSON_ENCODE,
    "window_change": _WINDOW_CHANGE,
    "large_delta": _LARGE_DELTA,
    "frequent_change": _FREQUENT_CHANGE,
    "excessive_activity": _EXCESSIVE,
    "flag_alarmed": _FLAG_ALARMED,
    "flag_lost_card": _FLAG_LOST,
    "city_change_alerts": _CITY_ALERTS,
    "flagged_all": _FLAGGED_ALL,
    "stream_join": _STREAM_JOIN,
    "group_count": _GROUP_COUNT,
    "distinct_where": _DISTINCT_WHERE,
    "row_stats": _ROW_STATS,
}

_RISE = """
SELECT event_id, ts, event_type, d, value, MAX(value - low) OVER w AS rise FROM (
    SELECT *, MIN(value) OVER w AS low FROM (SELECT *, {part} AS d FROM events)
    WINDOW w AS (PARTITION BY event_type, d ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WINDOW w AS (PARTITION BY event_type, d ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""

_DOCUMENTS = """
SELECT event_id, CASE WHEN json_valid(doc) THEN doc END AS doc FROM (
    SELECT event_id, '{"user": {"id": ' || user_id || ', "kind": "' || event_type || '"}, "props": ' || props
                     || ', "tags": ["' || event_type || '", ' || event_id || ']'
                     || CASE WHEN event_id % 10 = 0 THEN '' ELSE '}' END AS doc FROM events)
"""

_JSON_FIELDS = f"""
SELECT d.event_id, CAST(row_number() OVER (PARTITION BY d.event_id ORDER BY f.key) - 1 AS INTEGER) AS pos, f.key AS key,
       CAST(json(f.value) AS VARCHAR) AS value
FROM ({_DOCUMENTS}) d, json_each(d.doc) f WHERE d.doc IS NOT NULL
"""

ORACLE_SQL.update({
    "rolling_rise": f"SELECT event_id, ts, event_type, rise FROM ({_RISE.format(part=1)})",
    "window_rise": f"""SELECT event_type, d AS window_start, MAX(rise) AS rise, MIN(value) AS low
                       FROM ({_RISE.format(part=bucket('1 day'))}) GROUP BY event_type, d""",
    "json_documents": f"""SELECT event_id, CAST(json_extract_string(doc, '$.user.id') AS BIGINT) AS user_id,
                          json_extract_string(doc, '$.user.kind') AS kind, CAST(json_extract_string(doc, '$.props.k') AS INTEGER) AS k,
                          CAST(json_extract_string(doc, '$.tags[1]') AS BIGINT) AS second_tag,
                          TRY_CAST(json_extract_string(doc, '$.user.kind') AS INTEGER) AS kind_as_int FROM ({_DOCUMENTS})""",
    "json_fields": _JSON_FIELDS,
    "tumbling_revenue_sql": _TUMBLING,
    "sliding_revenue_sql": _SLIDING,
    "session_revenue_sql": _SESSION,
})
