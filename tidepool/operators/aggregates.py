"""Plain grouped aggregates and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """``SELECT keys, COUNT(*) ... GROUP BY keys`` (partial + final hash aggregate)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_where(df: DataFrame, cols: Sequence[str], predicate: Column | None = None) -> DataFrame:
    """``SELECT DISTINCT cols ... WHERE predicate``; the filter runs before the
    shuffle (and reaches the scan when it is on stored columns)."""
    if predicate is not None:
        df = df.where(predicate)
    return df.select(*cols).distinct()


def ongoing(df: DataFrame, flag_col: str, flag_value: str, casts: dict[str, str],
            strict: bool = False) -> DataFrame:
    """Keep rows whose flag equals ``flag_value``, then cast the given columns.

    With ANSI mode Spark may evaluate a cast before the filter, so the cast is
    ``try_cast`` unless ``strict``; on filtered rows both agree."""
    kept = df.where(F.col(flag_col) == F.lit(flag_value))
    out = []
    for c in df.columns:
        if c in casts:
            col = F.col(c).cast(casts[c]) if strict else F.col(c).try_cast(casts[c])
            out.append(col.alias(c))
        else:
            out.append(F.col(c))
    return kept.select(*out)


__all__ = ["group_count", "distinct_where", "ongoing"]
