"""Summarise the physical plan of every registered query (for PLANS.md).

Usage: python scripts/plan_summary.py [sf_dir] > PLANS.md
Counts shuffles, join strategies, Python/Arrow operators and windows, and
lists pushed filters per query (initial adaptive plan, before AQE re-plans).
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vellum.plans import registry  # noqa: E402
from vellum.session import local_session  # noqa: E402

OPS = [
    "Exchange hashpartitioning", "Exchange RoundRobinPartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
    "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
    "CartesianProduct", "MapInPandas", "MapInArrow", "PythonMapInArrow", "FlatMapCoGroupsInPandas",
    "ArrowEvalPython", "Window", "WindowGroupLimit", "Generate", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
]
SKIP = {"store_roundtrip", "store_append", "discover_files"}  # these write while being declared


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("# Physical plans of the registered queries\n")
    print(f"Initial adaptive plans at `{sf_dir}` (AQE may still turn a shuffle join into a broadcast one at run time).")
    print("Generated by `scripts/plan_summary.py`; full plans: `scripts/show_plans.py`.\n")
    print("| query | shuffles | joins | Python / Arrow | other | pushed filters |")
    print("|---|---|---|---|---|---|")
    for name, fn in registry.QUERIES.items():
        if name in SKIP:
            print(f"| {name} | (writes a table while declared; see tests) | | | | |")
            continue
        p = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        c = Counter()
        for op in OPS:
            c[op] = len(re.findall(re.escape(op) + r"\b", p))
        shuffles = sum(v for k, v in c.items() if k.startswith("Exchange "))
        joins = ", ".join(f"{k} {v}" for k, v in c.items() if "Join" in k or k == "CartesianProduct" if v) or "-"
        py = ", ".join(f"{k} {v}" for k, v in c.items() if k in ("MapInPandas", "MapInArrow", "PythonMapInArrow",
                                                               "FlatMapCoGroupsInPandas", "ArrowEvalPython") and v) or "-"
        other = ", ".join(f"{k} {v}" for k, v in c.items() if k in ("Window", "WindowGroupLimit", "Generate", "HashAggregate",
                                                                  "SortAggregate", "ObjectHashAggregate", "BroadcastExchange") and v) or "-"
        pushed = sorted({m for m in re.findall(r"PushedFilters: \[([^\]]+)\]", p) if m})
        print(f"| {name} | {shuffles} | {joins} | {py} | {other} | {'; '.join(pushed)[:120] or '-'} |")


if __name__ == "__main__":
    main()
