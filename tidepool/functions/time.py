"""Time conversions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_micros(col) -> Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` column (zone free)."""
    c = _c(col)
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)


def ntz_to_instant(col) -> Column:
    """Read a wall-clock ``timestamp_ntz`` as a UTC instant (``timestamp``).

    Streaming watermarks need ``timestamp``; a plain cast would reinterpret the
    wall clock in the session zone, this does not.
    """
    return F.timestamp_micros(ntz_micros(col))


def instant_to_ntz(col) -> Column:
    """Inverse of :func:`ntz_to_instant`."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), F.expr(_EPOCH_NTZ))


def order_number(col, dtype: str) -> Column:
    """A numeric stand-in that sorts like ``col`` (used for range chunking)."""
    c = _c(col)
    if dtype == "timestamp_ntz":
        return ntz_micros(c)
    if dtype == "timestamp":
        return F.unix_micros(c)
    if dtype == "date":
        return F.unix_date(c).cast("bigint")
    return c


def millis_to_ts(col) -> Column:
    """Epoch milliseconds (bigint) to ``timestamp`` (the source DDL's computed event time)."""
    return F.timestamp_millis(_c(col))


def parse_ts(col, pattern: str) -> Column:
    """Parse text with a datetime pattern, e.g. ``dd/MM/yyyy HH:mm:ss``."""
    return F.to_timestamp(_c(col), pattern)


def processing_time() -> Column:
    """Processing-time column; constant within one micro-batch."""
    return F.current_timestamp()


__all__ = ["ntz_micros", "ntz_to_instant", "instant_to_ntz", "order_number", "millis_to_ts",
           "parse_ts", "processing_time"]
