"""Summarise the physical plan of every registered query (writes PLANS.md).

usage: python tools/plan_summary.py [sf_dir]
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.registry import QUERIES, load_all  # noqa: E402
from tessera.session import get_session  # noqa: E402

CHECKS = [
    ("shuffles", r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobinPartitioning"),
    ("broadcasts", r"BroadcastExchange"),
    ("hash joins", r"(BroadcastHashJoin|ShuffledHashJoin|SortMergeJoin)"),
    ("sorts", r"\bSort \["),
    ("windows", r"\bWindow \["),
]
BAD = {"NestedLoopJoin": r"NestedLoopJoin", "Cartesian": r"CartesianProduct",
       "PythonUDF": r"BatchEvalPython|ArrowEvalPython"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    load_all()
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    lines = ["# Physical plan summary", "",
             f"Generated by `tools/plan_summary.py {sf_dir}` (executed plans, AQE final form).",
             "Counts are operator occurrences in the final plan, subqueries included.", "",
             "| query | shuffles | broadcasts | joins | sorts | windows | pushed filters | flags |",
             "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()   # run so AQE finalises the plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        joins = sorted(set(re.findall(r"(BroadcastHashJoin|ShuffledHashJoin|SortMergeJoin) \w*\s?(Inner|LeftOuter|LeftSemi|LeftAnti|FullOuter|RightOuter)?", plan)))
        counts = [str(len(re.findall(rx, plan))) for _, rx in CHECKS]
        counts[2] = ", ".join(f"{a} {b}".strip() for a, b in joins) or "0"
        pushed = "yes" if re.search(r"PushedFilters: \[[^\]]+\]|PartitionFilters: \[[^\]]+\]", plan) else "-"
        flags = [k for k, rx in BAD.items() if re.search(rx, plan)]
        lines.append(f"| `{name}` | " + " | ".join(counts) + f" | {pushed} | {', '.join(flags) or 'ok'} |")
        print(lines[-1], flush=True)
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
