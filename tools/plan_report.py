"""Write PLANS.md: per registered query, the shuffles, joins and scans of
its physical plan (from ``explain("formatted")``), to review partitioning,
pushdown and pruning at a glance.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from newsledger.plans.queries import QUERIES  # noqa: E402
from newsledger.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{os.path.basename(sf)}` (AQE re-plans at run time; "
          "broadcasts below are static estimates).\n")
    print("| query | exchanges | joins | aggregates | python | scans (columns read; pushed filters) |")
    print("|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf).explain("formatted")
        plan = buf.getvalue()
        tree = plan.split("\n\n")[0]
        ex = len(re.findall(r"Exchange \(", tree)) - len(re.findall(r"BroadcastExchange \(", tree))
        joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)"
                                      r" (\w+)", tree)))
        aggs = len(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate) \(", tree))
        py = len(re.findall(r"(ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|BatchEvalPython)", tree))
        scans = []
        for block in re.findall(r"\(\d+\) Scan parquet[^\n]*\n(.*?)(?:\n\n|\Z)", plan, re.S):
            loc = re.search(r"Location: \S+ \[file:[^\]]*/(\w+)\.parquet\]", block)
            rs = re.search(r"ReadSchema: struct<(.*)>", block)
            pf = re.search(r"PushedFilters: \[(.*)\]", block)
            cols = ",".join(c.split(":")[0] for c in (rs.group(1).split(",") if rs else []))
            scans.append(f"{loc.group(1) if loc else '?'}({cols}{'; ' + pf.group(1) if pf and pf.group(1) else ''})")
        jtxt = ", ".join(f"{a} {b}" for a, b in joins) or "-"
        print(f"| {name} | {ex} | {jtxt} | {aggs} | {py} | {'; '.join(scans)} |")


if __name__ == "__main__":
    main()
