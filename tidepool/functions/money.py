"""Amounts stored as binary doubles, as exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def money(col: str = "value") -> Column:
    """The amount as exact cents; an amount with a part of a cent is an error, not rounded.

    A double next to a whole number of cents may be off by two roundings
    (2.3e-16 of it) once multiplied by 100; one part in 1e14 is allowed."""
    v = F.col(col)
    cents = v * 100
    whole = F.abs(cents - F.round(cents)) <= F.abs(cents) * 1e-14
    return F.when(v.isNull() | whole, v.cast(MONEY)).otherwise(
        F.raise_error(F.concat(F.lit(f"{col} has a part of a cent: "), v.cast("string"))).cast(MONEY))


__all__ = ["MONEY", "money"]
