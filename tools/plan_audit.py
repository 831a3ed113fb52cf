"""Run every registered query and list the physical operators that matter at
scale: single-partition exchanges, Cartesian and nested-loop joins, Python
evaluation, sort-merge joins and windows (with whether a group limit feeds
them).  Reads the final adaptive plan after executing into the noop sink.

usage: python tools/plan_audit.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vetline import session  # noqa: E402
from vetline.plans.catalog import QUERIES  # noqa: E402

FLAGS = ["CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython",
         "ArrowEvalPython", "MapInPandas", "SortMergeJoin", "BroadcastHashJoin", "WindowGroupLimit"]


def audit(plan: str) -> dict:
    out = {f: plan.count(f) for f in FLAGS if f in plan}
    lines = [re.sub(r"^\*\(\d+\) ", "", ln.strip(" :+-")) for ln in plan.splitlines()]
    windows = [i for i, ln in enumerate(lines) if ln.startswith("Window [")]
    out["windows"] = len(windows)
    out["windows_on_group_limit"] = sum(1 for i in windows if i + 1 < len(lines)
                                        and lines[i + 1].startswith("WindowGroupLimit"))
    return out


def main():
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = session.build()
    for name in args or list(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(f"{name:24s} {audit(df._jdf.queryExecution().executedPlan().toString())}")


if __name__ == "__main__":
    main()
