"""Delimited-line parsing into typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field layouts of the line formats the jobs read (name, type).
SALE_LINE = [("sale_date", "string"), ("month", "string"), ("category", "string"),
             ("product", "string"), ("profit", "int")]
CAB_LINE = [("cab_id", "string"), ("plate", "string"), ("cab_type", "string"), ("driver", "string"),
            ("ongoing", "string"), ("pickup", "string"), ("destination", "string"),
            ("passengers", "string")]
AMOUNT_LINE = [("ts_ms", "bigint"), ("amount", "bigint")]
TICK_LINE = [("date", "string"), ("time", "string"), ("price", "double"), ("volume", "int")]
TXN_LINE = [("txn_id", "string"), ("txn_ts", "string"), ("city", "string"), ("customer_id", "string"),
            ("account", "string"), ("card_id", "string"), ("amount", "int")]
ALARMED_LINE = [("customer_id", "string"), ("account", "string")]
LOST_CARD_LINE = [("card_id", "string"), ("reported_ts", "string"), ("name", "string"),
                  ("status", "string")]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_fields(line, fields: Sequence[tuple[str, str]], sep: str = ",",
                 strict: bool = True) -> list[Column]:
    """Typed columns from one delimited string column.

    ``strict`` casts with ANSI semantics (a bad number fails the job, like a
    parse exception would); otherwise ``try_cast`` yields null.
    ``split_part`` is 1-based and returns '' for missing fields.
    """
    line = _c(line)
    out = []
    for i, (name, dtype) in enumerate(fields, start=1):
        raw = F.split_part(line, F.lit(sep), F.lit(i))
        if dtype != "string":
            raw = raw.cast(dtype) if strict else raw.try_cast(dtype)
        out.append(raw.alias(name))
    return out


def parse_lines(df: DataFrame, fields: Sequence[tuple[str, str]], line_col: str = "value",
                sep: str = ",", keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """``DataFrame[value]`` of lines -> typed columns (plus any ``keep`` columns)."""
    return df.select(*[F.col(k) for k in keep], *split_fields(line_col, fields, sep, strict))


def parse_sale_lines(df: DataFrame, line_col: str = "value") -> DataFrame:
    """Sale line -> (month, category, product, profit); the date field is dropped."""
    return parse_lines(df, SALE_LINE, line_col).drop("sale_date")


def key_by_field(df: DataFrame, index: int, name: str, line_col: str = "value",
                 sep: str = ",") -> DataFrame:
    """Attach field ``index`` (0-based) of the raw line as a key, keeping the line."""
    return df.withColumn(name, F.split_part(F.col(line_col), F.lit(sep), F.lit(index + 1)))


__all__ = ["SALE_LINE", "CAB_LINE", "AMOUNT_LINE", "TICK_LINE", "TXN_LINE", "ALARMED_LINE",
           "LOST_CARD_LINE", "split_fields", "parse_lines", "parse_sale_lines", "key_by_field"]
