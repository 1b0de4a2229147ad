"""Driver contract: bench.py prints one JSON line; entry/queries/oracle agree."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_query_has_an_oracle():
    # the optional training-data queries have one where SQL can express them
    assert set(E.queries()) - set(E.LLM_QUERIES) == set(E.oracle_sql()) - set(E.LLM_ORACLE_SQL)
    assert set(E.LLM_ORACLE_SQL) <= set(E.LLM_QUERIES)


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="tumbling_revenue,group_count")
    out = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"tumbling_revenue", "group_count"}
    assert rec["failed"] == []
