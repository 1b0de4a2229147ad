"""Text renderings of alerts and reports (structured columns stay primary).

``format_string`` uses the JVM formatter, so ``%.2f`` rounds half-up exactly
like the original job's ``String.format``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message templates of the alert and report lines.
DELTA_TEMPLATE = "Large Change Detected of %.2f%% (%s - %s) at  %s"
REPORT_TEMPLATE = "%s - %s, %s, %s, %.2f, %s, %s, %.2f"
ALERT_TEMPLATES = {
    "alarmed_customer": ("____ALARM___", "Transaction: (%s,%s) is by an ALARMED customer"),
    "lost_card": ("__ALARM__", "Transaction: (%s,%s) issued via LOST card"),
    "excessive_activity": ("__ALARM__", "(%s,%s,%s) marked for >10 TXNs"),
    "frequent_city_change": ("__ALARM__", "(%s,%s)marked for FREQUENT city changes"),
}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_double(col) -> Column:
    """Double rendered like Java's ``Double.toString`` (e.g. ``106.0``)."""
    return _c(col).cast("double").cast("string")


def delta_alert(pct, prev, cur, at) -> Column:
    return F.format_string(DELTA_TEMPLATE, _c(pct), java_double(prev), java_double(cur),
                           _c(at).cast("string"))


def window_report(start, end, max_price, min_price, price_change, max_vol, min_vol,
                  vol_change) -> Column:
    return F.format_string(REPORT_TEMPLATE, _c(start).cast("string"), _c(end).cast("string"),
                           java_double(max_price), java_double(min_price), _c(price_change),
                           _c(max_vol).cast("string"), _c(min_vol).cast("string"), _c(vol_change))


def alert_line(rule: str, key, line, n=None) -> Column:
    """One alert line as the original job printed it: ``(tag,message)`` where
    the message embeds ``(key,raw line)`` (and the count for the activity rule)."""
    tag, template = ALERT_TEMPLATES[rule]
    args = [_c(key).cast("string"), _c(line)]
    if n is not None:
        args.append(_c(n).cast("string"))
    return F.format_string("(%s,%s)", F.lit(tag), F.format_string(template, *args))


__all__ = ["DELTA_TEMPLATE", "REPORT_TEMPLATE", "ALERT_TEMPLATES", "java_double", "delta_alert",
           "window_report", "alert_line"]
