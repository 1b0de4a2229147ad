"""Row-wise statistics across several numeric columns (kept in the JVM)."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def row_total(cols: Sequence[str]) -> Column:
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return total


def row_mean(cols: Sequence[str]) -> Column:
    return row_total(cols).cast("double") / float(len(cols))


def row_sample_stdev(cols: Sequence[str]) -> Column:
    """Sample standard deviation (n - 1 denominator) of the row's values."""
    mean = row_mean(cols)
    ss = None
    for c in cols:
        d = F.col(c).cast("double") - mean
        ss = d * d if ss is None else ss + d * d
    return F.sqrt(ss / float(len(cols) - 1))


def row_summary(id_col: str, cols: Sequence[str], digits: int = 2) -> list[Column]:
    """(id, total, mean, stdev) with mean and stdev rounded half-up."""
    return [F.col(id_col), row_total(cols).alias("total"),
            F.round(row_mean(cols), digits).alias("mean"),
            F.round(row_sample_stdev(cols), digits).alias("stdev")]


def row_summary_udf(cols: Sequence[str]):
    """The same summary as a vectorised (Arrow) pandas UDF returning a struct,
    for users who bring their own row function; prefer :func:`row_summary`,
    which stays inside whole-stage codegen."""
    from pyspark.sql.functions import pandas_udf

    n = len(cols)

    @pandas_udf("total long, mean double, stdev double")
    def summary(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.astype("float64")
        total = frame.sum(axis=1)
        mean = total / n
        dev = frame.sub(mean, axis=0)
        ss = (dev * dev).sum(axis=1)
        return pd.DataFrame({"total": total.astype("int64"), "mean": mean.round(2),
                             "stdev": (ss / (n - 1)) ** 0.5})

    return summary(F.struct(*[F.col(c) for c in cols]))


__all__ = ["row_total", "row_mean", "row_sample_stdev", "row_summary", "row_summary_udf"]
