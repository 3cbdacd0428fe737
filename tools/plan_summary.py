"""Summarise the physical plan of every registered table query (markdown table on stdout).

Usage: python tools/plan_summary.py [sf_dir]
Counts come from the plan Spark would run before adaptive re-planning.
"""

import re
import sys

sys.path.insert(0, ".")
from strata.plans.catalog import QUERIES  # noqa: E402
from strata.session import local_session  # noqa: E402


def summarise(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ", ".join(sorted({m for m in re.findall(
            r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
            r"(?: \[[^\]]*\], \[[^\]]*\], )?(\w+)?", plan) for m in [m[0] + (" " + m[1] if m[1] else "")]})) or "-",
        "partial_limit": "yes" if "WindowGroupLimit" in plan and "Partial" in plan else "-",
        "pushed_filters": len([f for f in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if f.strip()]),
        "python": "yes" if re.search(r"(BatchEvalPython|ArrowEvalPython|PythonUDF|InPandas)", plan) else "no",
    }


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("| query | shuffles | broadcasts | joins | partial WindowGroupLimit | scans with pushed filters | Python |")
    print("|---|---|---|---|---|---|---|")
    for k, q in QUERIES.items():
        plan = q(spark, d)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| `{k}` | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['partial_limit']} | "
              f"{s['pushed_filters']} | {s['python']} |")


if __name__ == "__main__":
    main()
