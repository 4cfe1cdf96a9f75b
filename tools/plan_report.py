"""Final adaptive plans of the headline queries, as they would be on a cluster.

Auto-broadcast is switched off (at 100 TB no input side fits under the
threshold), each query is executed (collected) on sf0.01, and the final physical plan is
summarised: parquet scans, hash exchanges (with their keys), reused exchanges.

    python tools/plan_report.py > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stride.plans import registry as R  # noqa: E402
from stride.session import local_session  # noqa: E402

QUERIES = ("features", "request_features", "progress_states", "intervals")


def _tree(plan: str) -> list[str]:
    final = plan.split("== Initial Plan ==")[0]
    keep = []
    for line in final.splitlines():
        s = line.strip()
        m = re.search(r"(ReusedExchange|Exchange hashpartitioning\(([^)]*)\)|FileScan parquet|SortMergeJoin|"
                      r"BroadcastHashJoin|Window \[|HashAggregate\(keys=\[[^]]*\]|Generate|ShuffledHashJoin)", s)
        if not m:
            continue
        depth = (len(line) - len(line.lstrip(" :+-"))) // 3
        txt = m.group(0)
        if txt.startswith("Exchange"):
            keys = re.sub(r"#\d+L?", "", m.group(2))
            txt = f"Exchange hash({keys})"
        elif txt.startswith("ReusedExchange"):
            src = re.search(r"Exchange hashpartitioning\(([^)]*)\)", s)
            txt = "ReusedExchange of hash(" + re.sub(r"#\d+L?", "", src.group(1) if src else "?") + ")"
        elif txt.startswith("FileScan"):
            cols = re.search(r"FileScan parquet \[([^]]*)\]", s)
            txt = "Scan parquet [" + re.sub(r"#\d+L?", "", cols.group(1) if cols else "") + "]"
        elif txt.startswith("HashAggregate"):
            txt = re.sub(r"#\d+L?", "", txt) + "]"
        keep.append("  " * min(depth, 40) + txt)
    return keep


def main() -> None:
    spark = local_session(8, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    print("# Final plans of the headline queries (auto-broadcast off, sf0.01)\n")
    print("Generated by `tools/plan_report.py`. Indentation is plan depth; only scans, exchanges, joins,")
    print("windows, aggregates and generators are shown.\n")
    for name in QUERIES:
        df = R.QUERIES[name](spark, "/root/testdata/sf0.01")
        df.collect()  # run this DataFrame's own plan, so the final adaptive plan is shown
        plan = df._jdf.queryExecution().executedPlan().toString()
        tree = _tree(plan)
        n_ex = sum(1 for t in tree if t.strip().startswith("Exchange"))
        n_re = sum(1 for t in tree if t.strip().startswith("ReusedExchange"))
        n_scan = sum(1 for t in tree if t.strip().startswith("Scan parquet"))
        print(f"## {name}\n")
        print(f"{n_scan} parquet scans, {n_ex} hash exchanges, {n_re} reused exchanges.\n")
        print("```")
        print("\n".join(tree))
        print("```\n")


if __name__ == "__main__":
    main()
