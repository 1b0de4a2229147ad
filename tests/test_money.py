import os

import pandas as pd
import pytest

from tidepool.functions.money import money
from tidepool.plans.catalog import BATCH_QUERIES

REVENUE = [f"{w}_revenue{form}" for w in ("tumbling", "sliding", "session") for form in ("", "_sql")]


def _events(scratch, values):
    os.makedirs(f"{scratch}/sf", exist_ok=True)
    rows = [(i, pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=i), 1, "a", v, '{"k": 1}') for i, v in enumerate(values)]
    pd.DataFrame(rows, columns=["event_id", "ts", "user_id", "event_type", "value", "props"]).to_parquet(
        f"{scratch}/sf/events.parquet", index=False, coerce_timestamps="us")
    return f"{scratch}/sf"


@pytest.mark.parametrize("name", REVENUE)
def test_a_part_of_a_cent_is_an_error_in_every_revenue_query(spark, scratch, name):
    for bad in (1.005, 5.00000001):
        with pytest.raises(Exception, match="part of a cent"):
            BATCH_QUERIES[name](spark, _events(scratch, [bad, 1.0])).collect()
    sums = {r["window_sales"] for r in BATCH_QUERIES[name](spark, _events(scratch, [0.1, 0.2, 4.35, 1.15])).collect()}
    assert sums == {5.8}


def test_whole_cents_pass_at_every_size(spark):
    cents = [1, 7, 29, 57, 115, 435, 10**6 + 1, 10**9 + 7, 10**11 + 3, 999_999_999_999, -29, 0]
    rows = spark.createDataFrame([(c, c / 100) for c in cents] + [(None, None)], "c long, value double")
    assert all(r["m"] is None if r["c"] is None else int(r["m"] * 100) == r["c"] for r in rows.select("c", money().alias("m")).collect())
