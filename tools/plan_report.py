"""Physical-plan summary of every registered query: shuffles, broadcasts and
operators that would hurt at scale (cartesian / nested-loop joins, single
partition exchanges, row-at-a-time Python).

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# queries that write or stream while being built (their plan is a plain scan of the written table)
EAGER = {"frame_store_roundtrip", "stream_frames", "stream_resource_windows", "sweep_csv", "metrics_json", "svd_topk"}
FLAGS = ["CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition", "BatchEvalPython",
         "MapInPandas", "SortMergeJoin", "Window"]


def main() -> None:
    from framelake.catalog import QUERIES
    from framelake.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | shuffles | broadcasts | notable operators |")
    print("| --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name in EAGER:
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning)", plan))
        flags = [f for f in FLAGS if f in plan]
        print(f"| `{name}` | {shuffles} | {plan.count('BroadcastExchange')} | {', '.join(flags) or '-'} |")


if __name__ == "__main__":
    main()
