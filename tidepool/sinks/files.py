"""File sinks for tables and streams.

A text sink takes exactly one string column, so rows are rendered first
(``render_line``).  Bucketed sinks add an hourly ``bucket`` column
(``yyyy-MM-dd--HH`` of processing or event time) and partition by it, which
gives one directory per hour like a rolling file sink; the streaming file
sink commits files atomically through its checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: directory name pattern of hourly buckets.
BUCKET_FORMAT = "yyyy-MM-dd--HH"


def render_line(cols: Sequence[str], sep: str = ",", wrap: str | None = "()") -> Column:
    """Tuple-like text of a row, e.g. ``(a,b,1)``; nulls render as ``null``."""
    body = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])
    if wrap:
        body = F.concat(F.lit(wrap[0]), body, F.lit(wrap[1]))
    return body.alias("value")


def with_bucket(df: DataFrame, time_col: str | None = None, name: str = "bucket") -> DataFrame:
    """Add the hourly bucket of ``time_col`` (processing time when None)."""
    t = F.col(time_col) if time_col else F.current_timestamp()
    return df.withColumn(name, F.date_format(t, BUCKET_FORMAT))


def write_text(df: DataFrame, path: str, cols: Sequence[str] | None = None, sep: str = ",",
               wrap: str | None = "()", mode: str = "overwrite") -> None:
    """Write rows as text lines (UTF-8)."""
    cols = list(cols or df.columns)
    df.select(render_line(cols, sep, wrap)).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, sep: str = " ", line_sep: str = "\n",
              header: bool = False, mode: str = "overwrite") -> None:
    """CSV with custom field and row delimiters."""
    df.write.mode(mode).option("sep", sep).option("lineSep", line_sep) \
        .option("header", header).csv(path)


def write_bucketed(df: DataFrame, path: str, fmt: str = "parquet", time_col: str | None = None,
                   mode: str = "append") -> None:
    """Batch write into hourly bucket directories."""
    with_bucket(df, time_col).write.mode(mode).partitionBy("bucket").format(fmt).save(path)


def stream_bucketed(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                    time_col: str | None = None, output_mode: str = "append",
                    available_now: bool = True):
    """Streaming write into hourly bucket directories; returns the running query."""
    w = (with_bucket(df, time_col).writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).partitionBy("bucket"))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start(path)


def stream_text(df: DataFrame, path: str, checkpoint: str, cols: Sequence[str] | None = None,
                available_now: bool = True):
    """Streaming text sink of rendered rows."""
    cols = list(cols or df.columns)
    w = (df.select(render_line(cols)).writeStream.format("text").outputMode("append")
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start(path)


def show(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    """Print a table (bounded: ``n`` rows) or start a console sink for a stream."""
    if df.isStreaming:
        df.writeStream.format("console").option("truncate", truncate).start()
    else:
        df.show(n, truncate)


__all__ = ["BUCKET_FORMAT", "render_line", "with_bucket", "write_text", "write_csv",
           "write_bucketed", "stream_bucketed", "stream_text", "show"]
