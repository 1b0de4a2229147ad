"""Summarise the physical plan of every batch query (no execution beyond
the small planning passes some operators run).

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepool.plans.catalog import BATCH_QUERIES  # noqa: E402
from tidepool.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (\w[\w ]*?)\s*$", plan, re.M)
    return {
        "shuffles": sum(n == "Exchange" for n in nodes),
        "broadcasts": sum(n == "BroadcastExchange" for n in nodes),
        "windows": sum(n == "Window" for n in nodes),
        "python": sum(("Python" in n or "Pandas" in n or "ArrowEval" in n) for n in nodes),
        "scans": sum(n.startswith("Scan") for n in nodes),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan))),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    print(f"| query | shuffles | broadcasts | windows | python stages | scans | pushed filters |")
    print("|---|---:|---:|---:|---:|---:|---|")
    for name, fn in BATCH_QUERIES.items():
        buf = io.StringIO()
        df = fn(spark, sf_dir)
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        s = summarise(buf.getvalue())
        pushed = "; ".join(p for p in s["pushed"] if p != "IsNotNull(user_id)")[:90]
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['windows']} | {s['python']} "
              f"| {s['scans']} | {pushed} |")
    spark.stop()


if __name__ == "__main__":
    main()
