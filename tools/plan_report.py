"""Physical-plan summary of registered queries (operator counts), as markdown.

Usage: python tools/plan_report.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelcast.plans import catalog  # noqa: E402
from panelcast.session import local_session  # noqa: E402

NODES = [
    ("Exchange hashpartitioning", r"Exchange hashpartitioning"),
    ("Exchange rangepartitioning", r"Exchange rangepartitioning"),
    ("BroadcastExchange", r"BroadcastExchange"),
    ("Sort", r"\bSort \["),
    ("Window", r"\bWindow \["),
    ("HashAggregate", r"\bHashAggregate\("),
    ("SortAggregate", r"\bSortAggregate\("),
    ("SortMergeJoin", r"\bSortMergeJoin"),
    ("BroadcastHashJoin", r"\bBroadcastHashJoin"),
    ("BroadcastNestedLoopJoin", r"\bBroadcastNestedLoopJoin"),
    ("CartesianProduct", r"\bCartesianProduct"),
    ("Python UDF", r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsIn"),
    ("Scan parquet", r"FileScan parquet|Scan parquet"),
    ("Scan checkpoint", r"Scan ExistingRDD|ExistingRDD"),
]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n, (_, sql) in catalog.REGISTRY.items() if sql is not None]
    spark = local_session(8)
    print("# Physical plans of the registered queries\n")
    print(f"Operator counts in the physical plan Spark chooses before execution ({sf_dir}, AQE on).")
    print("Upstream intermediates that a query materialises appear as Parquet scans.\n")
    print("| query | " + " | ".join(n for n, _ in NODES) + " |")
    print("| --- | " + " | ".join("---" for _ in NODES) + " |")
    for name in names:
        df = catalog.REGISTRY[name][0](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(rx, plan)) for _, rx in NODES]
        print(f"| {name} | " + " | ".join(str(c) if c else "" for c in counts) + " |")


if __name__ == "__main__":
    main()
