"""Print a markdown table of the executed physical plan of every registered plan.

Usage: python tests/plan_report.py [sf_dir]
Counts come from the final adaptive plan after running each query once.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stats(plan: str) -> dict[str, int | str]:
    plan = plan.split("== Initial Plan ==")[0]  # the final adaptive plan only
    return {
        "shuffles": sum(1 for line in plan.split("\n") if "ReusedExchange" not in line
                        and re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", line)),
        "reused": plan.count("ReusedExchange"),
        "broadcast joins": plan.count("BroadcastHashJoin"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "partial top-k": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "pushed filter": "yes" if re.search(r"PushedFilters: \[[^\]]*EqualTo", plan) else "",
        "cartesian / Python": ", ".join(x for x in ("CartesianProduct", "BroadcastNestedLoopJoin",
                                                    "BatchEvalPython", "ArrowEvalPython") if x in plan),
    }


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from marquee.session import checkpoint_dir, local_session
    import __spark_entry__ as E

    spark = local_session()
    checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="marquee-plans-"))
    cols = None
    for name, fn in E.queries().items():
        df = fn(spark, sf_dir)
        df.collect()
        st = stats(df._jdf.queryExecution().executedPlan().toString())
        if cols is None:
            cols = list(st)
            print("| plan | " + " | ".join(cols) + " |")
            print("| --- " * (len(cols) + 1) + "|")
        print(f"| {name} | " + " | ".join(str(st[c]) for c in cols) + " |")


if __name__ == "__main__":
    main(sys.argv[1:])
