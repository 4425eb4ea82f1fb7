"""Summarise the physical plan of every registered query: python tests/plan_report.py [sf_dir] > PLANS.md"""

import re
import sys

sys.path.insert(0, ".")

from goldvein.session import build_session  # noqa: E402
import __spark_entry__ as E  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = build_session("local[8]", 16)
KINDS = {
    "scans": r"FileScan parquet|Scan ExistingRDD",
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin",
    "expand": r"\bExpand\b",
    "windows": r"\bWindow\b",
    "session merges": r"MergingSessions",
}
print(f"# Physical plans at {sf} (local[8], shuffle partitions 16, before AQE re-planning)\n")
print("Counts of operators in each query's executed plan; streaming queries show the read-back scan.\n")
print("| query | " + " | ".join(KINDS) + " |")
print("|---|" + "---|" * len(KINDS))
for name, fn in E.queries().items():
    plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
    counts = [len(re.findall(p, plan)) for p in KINDS.values()]
    print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
