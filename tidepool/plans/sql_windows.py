"""The window queries in SQL form, over temp views.

Spark SQL has no ``TUMBLE``/``HOP``/``SESSION`` table functions; the group
key is ``window(ts, size)``, ``window(ts, size, slide)`` (size first, unlike
``HOP(time, slide, size)``) or ``session_window(ts, gap)`` (gap as a string;
an interval literal is rejected there).  Catalyst produces the same plan as
the DataFrame form.  The sliding query adds rows up per slide-wide pane and
expands the panes, not the rows, into windows; the session query adds rows up
per gap-wide pane, whose rows always share a session, and merges the panes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import session as S
from ..functions.money import money
from ..sources.tables import events

_REVENUE = "CAST(SUM(amount * volume) AS DOUBLE)"


def _view(spark: SparkSession, sf_dir: str) -> None:
    S.configure(spark)
    events(spark, sf_dir).withColumn("amount", money()).createOrReplaceTempView("salesitems")


def tumbling_revenue_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    _view(spark, sf_dir)
    return spark.sql(f"""
        SELECT user_id, w.start AS window_start, w.end AS window_end,
               {_REVENUE} AS window_sales, COUNT(*) AS n_events
        FROM (SELECT *, window(ts, '1 hour') AS w FROM salesitems)
        GROUP BY user_id, w""")


def sliding_revenue_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    _view(spark, sf_dir)
    return spark.sql(f"""
        WITH panes AS (
            SELECT user_id, window.start AS pane, SUM(amount * volume) AS sales, COUNT(*) AS n
            FROM salesitems
            GROUP BY user_id, window(ts, '10 minutes'))
        SELECT user_id, window.start AS window_start, window.end AS window_end,
               CAST(SUM(sales) AS DOUBLE) AS window_sales, SUM(n) AS n_events
        FROM panes
        GROUP BY user_id, window(pane, '30 minutes', '10 minutes')""")


def session_revenue_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    _view(spark, sf_dir)
    return spark.sql("""
        WITH panes AS (
            SELECT user_id, MIN(ts) AS first_ts, MAX(ts) AS last_ts, SUM(amount * volume) AS sales, COUNT(*) AS n
            FROM salesitems
            GROUP BY user_id, window(ts, '3 hours')),
        spans AS (
            SELECT *, CONCAT(CAST(TIMESTAMPDIFF(MICROSECOND, first_ts, last_ts + INTERVAL 3 HOURS) AS STRING),
                             ' microseconds') AS span
            FROM panes)
        SELECT user_id, session_window.start AS window_start, session_window.end AS window_end,
               CAST(SUM(sales) AS DOUBLE) AS window_sales, SUM(n) AS n_events
        FROM spans
        GROUP BY user_id, session_window(first_ts, span)""")


SQL_QUERIES = {
    "tumbling_revenue_sql": tumbling_revenue_sql,
    "sliding_revenue_sql": sliding_revenue_sql,
    "session_revenue_sql": session_revenue_sql,
}
