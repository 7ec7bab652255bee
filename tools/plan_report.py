"""Run every catalogue query and summarise its final (AQE) physical plan → PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts per query: shuffle exchanges, reused exchanges, broadcast / sort-merge
joins, window operators, sorts, Python-evaluated operators, scans with pushed
filters.  The plan is read after execution, so AQE decisions are included.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fintide.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"\bExchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "reused": r"ReusedExchange",
    "bcast_joins": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "windows": r"\bWindow\b",
    "sorts": r"\bSort \[",
    "python": r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas|FlatMapGroupsInPandasWithState)",
    "pushed_scans": r"PushedFilters: \[[^\]]",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    from fintide.plans import catalog

    print(f"# Physical plans (final AQE plans, {sf_dir}, local[{os.environ.get('BENCH_CPUS', '8')}])\n")
    print("Generated by `tools/plan_report.py` from the *final* adaptive plans (after execution), so joins")
    print("AQE converted to broadcast after measuring the small side show as broadcast joins. Queries that")
    print("iterate (TTL replay, medians, split input) or write/read tables show the plan of the returned")
    print("DataFrame; their checkpointed rounds and writes are separate jobs (`pushed_scans` 0 = reads a")
    print("checkpoint or written table).\n")
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("|" + " --- |" * (len(PATTERNS) + 1))
    for name, fn in catalog.queries().items():
        try:
            df = fn(spark, sf_dir)
            qe = df._jdf.queryExecution()
            qe.toRdd().count()  # executes this very plan, so AQE's final decisions are visible
            plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]
            counts = [len(re.findall(p, plan)) for p in PATTERNS.values()]
            print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |", flush=True)
        except Exception as e:  # keep going; report the failure in the table
            print(f"| {name} | error: {type(e).__name__} |", flush=True)


if __name__ == "__main__":
    main()
