"""JSON decode / encode of message values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decode(df: DataFrame, schema, value_col: str = "value", keep: Sequence[str] = (),
           mode: str = "PERMISSIVE") -> DataFrame:
    """JSON text -> typed columns.  ``PERMISSIVE`` gives nulls for bad records,
    ``FAILFAST`` fails the query."""
    parsed = F.from_json(F.col(value_col).cast("string"), schema, {"mode": mode}).alias("_j")
    return df.select(*[F.col(k) for k in keep], parsed).select(*keep, "_j.*")


def encode(cols: Sequence[str] | None = None, df: DataFrame | None = None,
           timestamp_format: str | None = None) -> Column:
    """Row -> JSON text (the message ``value``)."""
    names = list(cols) if cols is not None else list(df.columns)
    opts = {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format} \
        if timestamp_format else {}
    return F.to_json(F.struct(*[F.col(n) for n in names]), opts)


def to_messages(df: DataFrame, key_col: str | None = None,
                timestamp_format: str | None = None) -> DataFrame:
    """``DataFrame -> (key, value)`` ready for a message-queue sink."""
    value = encode(df=df, timestamp_format=timestamp_format).alias("value")
    if key_col:
        return df.select(F.col(key_col).cast("string").alias("key"), value)
    return df.select(value)


def parse_document(col) -> Column:
    """Schemaless JSON document -> VARIANT (bad input gives null)."""
    return F.try_parse_json(_c(col))


def document_field(doc, path: str, dtype: str) -> Column:
    """One value of a VARIANT by its path, e.g. ``$.user.id`` or ``$.tags[0]``; null where it is absent or of another type."""
    return F.try_variant_get(_c(doc), path, dtype)


def document_schema(doc) -> Column:
    """Aggregate: the schema that all documents of a group fit."""
    return F.schema_of_variant_agg(_c(doc))


def explode_document(df: DataFrame, doc_col: str, keep: Sequence[str]) -> DataFrame:
    """One row per field of an object or element of an array: ``keep``, ``pos``, ``key`` (null in arrays), ``value`` as JSON text.

    Fields come in the order of their names.  Null and scalar documents give no row."""
    fields = df.sparkSession.tvf.variant_explode(F.col(doc_col).outer())
    return df.lateralJoin(fields).select(*keep, "pos", "key", F.to_json("value").alias("value"))


def json_field(col, path: str, dtype: str = "string") -> Column:
    """Extract one field, e.g. ``json_field('props', '$.k', 'int')``."""
    return F.get_json_object(_c(col), path).cast(dtype)


__all__ = ["decode", "encode", "to_messages", "parse_document", "document_field", "document_schema",
           "explode_document", "json_field"]
