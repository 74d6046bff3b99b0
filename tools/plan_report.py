"""Summarise the physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Per query: number of shuffles, join strategies, aggregates, windows, and
whether the Parquet scans received pushed filters and a pruned read schema.
Plans are taken with AQE off so the static plan (what a large input gets
before runtime re-planning) is shown.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from emporion.plans.queries import QUERIES  # noqa: E402
from emporion.session import local_session  # noqa: E402

OPS = ["Exchange", "BroadcastExchange", "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
       "Expand", "Window", "WindowGroupLimit", "Generate", "BatchEvalPython", "ArrowEvalPython"]


def summarize(plan: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    counts = {op: nodes.count(op) for op in OPS if nodes.count(op)}
    scans = re.findall(r"^\(\d+\) Scan parquet.*?(?=^\(\d+\))", plan, flags=re.M | re.S)
    pushed = sum(1 for s in scans if re.search(r"PushedFilters: \[.+\]", s))
    schemas = [re.search(r"ReadSchema: struct<(.*)>", s) for s in scans]
    widths = [len(m.group(1).split(",")) if m else 0 for m in schemas]
    partial_limit = "Partial" in plan and "WindowGroupLimit" in plan
    return {"counts": counts, "scans": len(scans), "scans_with_pushed_filters": pushed,
            "read_columns": widths, "partial_window_limit": partial_limit}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    # static plan as for large inputs: no size-based broadcast of growing tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    print("# Physical plan summary\n")
    print(f"Input `{sf}`; AQE off and auto-broadcast off, i.e. the plan a large input gets before runtime "
          "re-planning (explicit broadcasts of fixed-size tables remain). Generated by `tools/plan_report.py`.\n")
    print("| query | shuffles | joins | aggregates | windows | scans (pushed filters) | columns read per scan |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        s = summarize(plan)
        c = s["counts"]
        joins = ", ".join(f"{k}×{v}" for k, v in c.items() if "Join" in k or k == "CartesianProduct") or "-"
        aggs = ", ".join(f"{k}×{v}" for k, v in c.items() if "Aggregate" in k or k == "Expand") or "-"
        wins = ", ".join(f"{k}×{v}" for k, v in c.items() if k.startswith("Window")) or "-"
        if s["partial_window_limit"]:
            wins += " (partial limit before shuffle)"
        print(f"| `{name}` | {c.get('Exchange', 0)} | {joins} | {aggs} | {wins} | "
              f"{s['scans']} ({s['scans_with_pushed_filters']}) | {s['read_columns']} |")
    spark.stop()


if __name__ == "__main__":
    main()
