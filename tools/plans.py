"""Summarise the physical plan of every registered query into PLANS.md.

    python tools/plans.py [sf_dir]

Per query: tables scanned with the columns read and the filters pushed into the
parquet reader, shuffle exchanges, join strategies, aggregates (partial = map-side
combine) and any Python/window/cartesian node.  The plan is the one Spark would
run (AQE may still coalesce partitions or switch a join to broadcast at run time).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import get_session  # noqa: E402


def summarise(plan: str) -> dict:
    scans = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\].*?Location: [^\[]*\[file:[^\]]*/(\w+)\.parquet\]"
                         r".*?PushedFilters: \[(.*?)\], ReadSchema: struct<([^>]*)>", plan, re.S):
        cols = [c.split(":")[0] for c in m.group(4).split(",") if c]
        pushed = m.group(3).strip()
        scans.append(f"{m.group(2)}({', '.join(cols)})" + (f" pushed[{pushed}]" if pushed else ""))
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                       r"CartesianProduct)[^\n]*?(Inner|LeftOuter|FullOuter|LeftAnti|LeftSemi|Cross)",
                       plan)
    return {
        "scans": sorted(set(scans)),
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                    r"Exchange SinglePartition", plan)),
        "joins": [f"{a} {b}" for a, b in joins],
        "partial_aggs": len(re.findall(r"partial_", plan)) > 0,
        "python": "ArrowEvalPython" in plan or "BatchEvalPython" in plan,
        "window": "Window" in plan,
        "expand": "Expand" in plan,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16,
                        extra_conf={"spark.sql.maxMetadataStringLength": "2000"})
    from strata.plans.catalog import QUERIES  # the training-data queries run many jobs each: see the README
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/plans.py` on `{sf}` (initial plan; AQE may still coalesce or "
           "switch joins to broadcast at run time). Hierarchy queries show the final step "
           "after the checkpointed closure rounds.", "",
           "| query | exchanges | joins | map-side agg | notes | scans (columns read, pushed filters) |",
           "| --- | --- | --- | --- | --- | --- |"]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        notes = ", ".join(k for k in ("python", "window", "expand") if s[k]) or ""
        joins = "; ".join(s["joins"]) or "-"
        out.append(f"| {name} | {s['exchanges']} | {joins} | {'yes' if s['partial_aggs'] else '-'} "
                   f"| {notes} | {'; '.join(s['scans'])} |")
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
         "w").write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
