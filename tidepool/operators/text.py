"""Line-level text operators (word count over whole lines)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines(docs: DataFrame, text_col: str = "text", name: str = "line") -> DataFrame:
    """Every line of every text (split on ``\\n``), whole texts, nothing dropped."""
    return docs.select(F.explode(F.split(F.col(text_col), "\n", -1)).alias(name))


def word_count(lines_df: DataFrame, col: str = "line", prefix: str | None = "N",
               name: str = "n") -> DataFrame:
    """Count identical values, optionally keeping only those starting with
    ``prefix`` (case-sensitive).  The value is taken whole: no tokenising.
    Map-side partial counts make repeated hot lines cheap to shuffle."""
    df = lines_df
    if prefix is not None:
        df = df.where(F.startswith(F.col(col), F.lit(prefix)))
    return df.groupBy(F.col(col).alias("word")).agg(F.count(F.lit(1)).alias(name))


__all__ = ["lines", "word_count"]
