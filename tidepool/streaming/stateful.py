"""Stateful processors for order-dependent logic on unbounded input.

Window-to-window comparison (percent change of a window maximum against the
key's previous window) needs state that outlives a window; on a stream it
runs after the windowed aggregation has emitted closed windows (append
mode), as a ``transformWithStateInPandas`` processor keyed by the series key.
Only one small value per key is stored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .runners import LateRowsDropped

PREV_SCHEMA = StructType([StructField("prev_max", DoubleType(), True)])
PREV_MAXIMA_SCHEMA = StructType([StructField("prev_price", DoubleType(), True),
                                 StructField("prev_volume", LongType(), True)])


class PreviousWindowDelta(StatefulProcessor):
    """Input: closed windows of one key (``window_start``, ``window_end``,
    ``cur_max``, ``max_ts``).  Output: alerts where the maximum moved by more
    than ``threshold`` percent (strict) against the previous window of the
    key; the first window of a key never alerts."""

    def __init__(self, key: str, threshold: float):
        self.key = key
        self.threshold = float(threshold)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prev = handle.getValueState("prev_max", PREV_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("window_start")
        prev = self.prev.get()[0] if self.prev.exists() else None
        out = []
        for rec in batch.itertuples(index=False):
            cur = float(rec.cur_max)
            if prev is not None and prev != 0:
                change = ((cur - prev) / prev) * 100.0
                if abs(change) > self.threshold:
                    out.append((key[0], rec.window_start, rec.window_end, prev, cur, change, rec.max_ts))
            prev = cur
        if prev is not None:
            self.prev.update((prev,))
        if out:
            yield pd.DataFrame(out, columns=[self.key, "window_start", "window_end", "prev_max",
                                             "cur_max", "pct_change", "max_ts"])

    def close(self) -> None:
        pass


def _pct(cur, prev) -> float:
    return 0.0 if prev is None or prev == 0 else ((cur - prev) / prev) * 100.0


class WindowReport(StatefulProcessor):
    """Input: closed windows of one key with ``max_price``/``max_volume`` (and
    any other stats).  Output: every window plus the percent change of both
    maxima against the key's previous window (0.0 for the first).  State: the
    previous window's two maxima."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prev = handle.getValueState("prev_maxima", PREV_MAXIMA_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("window_start")
        prev_p, prev_v = self.prev.get() if self.prev.exists() else (None, None)
        price_change, volume_change = [], []
        for p, v in zip(batch["max_price"].tolist(), batch["max_volume"].tolist()):
            price_change.append(_pct(float(p), prev_p))
            volume_change.append(_pct(float(v), prev_v))
            prev_p, prev_v = float(p), int(v)
        self.prev.update((prev_p, prev_v))
        out = batch[self.columns].copy()
        out["max_price_change"] = price_change
        out["max_volume_change"] = volume_change
        yield out

    def close(self) -> None:
        pass


def _order_value(row: pd.Series, order_cols: list[str]) -> tuple:
    """A row's place in the order as plain values that compare; nulls last, as ``sort_values`` puts them."""
    values = [row[c] for c in order_cols]
    return tuple((1, 0) if pd.isna(v) else (0, v.value if isinstance(v, pd.Timestamp) else getattr(v, "item", lambda v=v: v)())
                 for v in values)


def in_order(pdf: pd.DataFrame, order_cols: list[str], last: bytes | None, key) -> bytes | None:
    """The order value that a key's sorted rows of one micro-batch end with, to
    keep in its state; raises if the first of them stands before ``last``, the
    value an earlier micro-batch ended with (its rows are already written)."""
    if not len(pdf):
        return last
    first, before = _order_value(pdf.iloc[0], order_cols), pickle.loads(last) if last is not None else None
    if before is not None and first < before:
        raise LateRowsDropped(f"key {key}: a row at {first} of ({', '.join(order_cols)}) came in a later micro-batch than "
                              f"one at {before}; raise the rate limit or order the files by time")
    return pickle.dumps(_order_value(pdf.iloc[-1], order_cols))


def rolling_state_fn(key_cols: list[str], order_cols: list[str], value_col: str, strict: bool = True):
    """``applyInPandasWithState`` function: per-record running count and sum
    of ``value_col`` per key, in ``order_cols`` order (one output row per input
    row).  A micro-batch's rows are sorted; a row that comes in a later
    micro-batch than one of its key that stands after it raises
    ``LateRowsDropped``, or with ``strict`` off counts where it arrives.  Pass an
    integer value (e.g. cents) to keep sums exact; a null value adds nothing.  A group holds one key's
    rows of one micro-batch, bounded by the trigger's batch size."""

    def fn(key, pdfs, state):
        n, total, last = state.get if state.exists else (0, 0, None)
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(order_cols)
        if strict:
            last = in_order(pdf, order_cols, last, key)
        counts = n + pd.Series(range(1, len(pdf) + 1), index=pdf.index, dtype="int64")
        sums = total + pdf[value_col].fillna(0).astype(type(total)).cumsum()  # nulls add nothing
        out = pdf[key_cols + order_cols].copy()
        out["running_count"] = counts
        out["running_sum"] = sums
        if len(pdf):
            n, total = int(counts.iloc[-1]), sums.iloc[-1].item()
        state.update((n, total, last))
        yield out

    return fn


__all__ = ["PreviousWindowDelta", "WindowReport", "PREV_SCHEMA", "PREV_MAXIMA_SCHEMA",
           "in_order", "rolling_state_fn"]
