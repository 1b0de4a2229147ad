"""Rule-based flagging of transactions and the union of all alerts.

Four rules over one transaction feed:

1. the customer is on an alarm list (membership);
2. the card is on a lost-card list (membership);
3. more than ``threshold`` transactions of a customer in one window;
4. the city changed at least twice within a customer's window.

Each rule yields rows of the same alert schema so they can be unioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .changes import frequent_change
from .joins import semi_join
from .windows import first_by, tumbling

# Rule names used in the alert stream.
RULE_ALARMED = "alarmed_customer"
RULE_LOST_CARD = "lost_card"
RULE_EXCESSIVE = "excessive_activity"
RULE_CITY_CHANGE = "frequent_city_change"


def alert_columns(rule: str, txn: Sequence[str], window_start: Column | None = None,
                  n: Column | None = None, prefix: str = "") -> list[Column]:
    """The common alert row: rule, the transaction's fields, window, count
    (the number of transactions behind the alert: 1 for a single-transaction rule)."""
    cols = [F.lit(rule).alias("rule")]
    cols += [F.col(f"{prefix}{c}").alias(c) for c in txn]
    cols.append((window_start if window_start is not None else F.lit(None)).cast("timestamp_ntz")
                .alias("window_start"))
    cols.append((n if n is not None else F.lit(1)).cast("bigint").alias("n"))
    return cols


def flag_members(txns: DataFrame, key_col: str, members: DataFrame, member_key: str,
                 rule: str, txn_cols: Sequence[str]) -> DataFrame:
    """Transactions whose ``key_col`` is on the member list (at most one alert each)."""
    hits = semi_join(txns, key_col, members, member_key)
    return hits.select(*alert_columns(rule, txn_cols))


def flag_members_many(txns: DataFrame, checks: Sequence[tuple[str, DataFrame, str, str]],
                      txn_cols: Sequence[str]) -> DataFrame:
    """Several membership rules over one feed, one alert per (transaction, rule).

    ``checks``: ``(key_col, members, member_key, rule)``.  All lists are
    applied in a single pass over the transactions: a left join per list with
    its distinct keys sets one flag per rule, flagged rows are exploded into
    one row per matched rule.  No hints: a list that Spark's statistics or
    AQE's measured size show to be small is broadcast, any other is shuffled.
    """
    flagged, hits = txns, []
    for i, (key_col, members, member_key, rule) in enumerate(checks):
        keys = members.select(F.col(member_key).alias(f"_m{i}")).dropDuplicates()
        flagged = flagged.join(keys, F.col(key_col) == F.col(f"_m{i}"), "left")
        hits.append(F.when(F.col(f"_m{i}").isNotNull(), F.lit(rule)))
    return flagged.select(*txn_cols, F.explode(F.array_compact(F.array(*hits))).alias("rule")).select(
        "rule", *txn_cols, F.lit(None).cast("timestamp_ntz").alias("window_start"),
        F.lit(1).cast("bigint").alias("n"))


def excessive_activity(txns: DataFrame, key: str, time_col: str, size: str,
                       order: Sequence[str], txn_cols: Sequence[str],
                       threshold: int = 10) -> DataFrame:
    """Windows with more than ``threshold`` transactions of one key, carrying
    the window's first transaction beside the count (once per window)."""
    per_window = tumbling(txns, time_col, size, [key], {
        "n": F.count(F.lit(1)),
        "_first": first_by([c for c in txn_cols if c != key], order),
    })
    hot = per_window.where(F.col("n") > threshold)
    return hot.select(F.lit(RULE_EXCESSIVE).alias("rule"),
                      *[(F.col(key) if c == key else F.col(f"_first.{c}")).alias(c) for c in txn_cols],
                      F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("n").cast("bigint").alias("n"))


def city_changes(txns: DataFrame, key: str, time_col: str, size: str, city: str,
                 order: Sequence[str], txn_cols: Sequence[str], min_changes: int = 2) -> DataFrame:
    """Every transaction from the ``min_changes``-th city change on, per key and window."""
    w = F.window(time_col, size)
    keyed = txns.withColumn("_wstart", w.start)
    flagged = frequent_change(keyed, [key, "_wstart"], order, city, min_changes)
    return flagged.select(*alert_columns(RULE_CITY_CHANGE, txn_cols, F.col("_wstart"),
                                         F.col("n_changes")))


def union_alerts(*alerts: DataFrame) -> DataFrame:
    """Bag union of same-schema alert frames (a narrow operation: no shuffle)."""
    out = alerts[0]
    for a in alerts[1:]:
        out = out.unionByName(a)
    return out


__all__ = ["RULE_ALARMED", "RULE_LOST_CARD", "RULE_EXCESSIVE", "RULE_CITY_CHANGE",
           "alert_columns", "flag_members", "flag_members_many", "excessive_activity", "city_changes",
           "union_alerts"]
