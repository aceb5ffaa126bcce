"""Write PLANS.md: the executed physical plan of every registered query, summarised.

    python tools/plan_report.py [/root/testdata/sf0.01]

Per query: exchanges (shuffles), joins, aggregate kinds, scans with their read
schema and pushed filters, whether any Python runs, and the final plan text.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(plan: str) -> dict:
    lines = plan.splitlines()
    ex = [l.strip(" :+-") for l in lines if "Exchange" in l and "Reused" not in l]
    joins = sorted({m.group(0) for l in lines for m in [re.search(r"\w*Join(Exec)?\b[^\[]*", l.strip(" :+-"))] if m})
    aggs = sorted({w for l in lines for w in ("HashAggregate", "SortAggregate", "ObjectHashAggregate") if w in l})
    scans = []
    for l in lines:
        if "FileScan" in l:
            name = re.search(r"FileScan (\w+)", l).group(1)
            rs = re.search(r"ReadSchema: (struct<.*?>)(,|$)", l)
            pf = re.search(r"PushedFilters: \[(.*?)\]", l)
            bucketed = "Bucketed: true" in l
            scans.append((name, rs.group(1)[:160] if rs else "", pf.group(1)[:120] if pf else "", bucketed))
    python = any(w in plan for w in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas"))
    return {"exchanges": ex, "joins": joins, "aggs": aggs, "scans": scans, "python": python}


def main(argv):
    from lodestar.session import get_spark
    from lodestar.plans.catalog import QUERIES
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `tools/plan_report.py` on `{sf}` (local[8], 8 shuffle partitions, AQE on;",
           "plans shown before AQE re-planning). `Exchange` lines are the shuffles.", ""]
    out.append("| query | shuffles | joins | aggregates | scans (bucketed) | Python |")
    out.append("| --- | --- | --- | --- | --- | --- |")
    details = []
    for name, q in QUERIES.items():
        df = q(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        nb = sum(1 for x in s["scans"] if x[3])
        out.append(f"| `{name}` | {len(s['exchanges'])} | {', '.join(s['joins']) or '-'} | "
                   f"{', '.join(s['aggs']) or '-'} | {len(s['scans'])} ({nb}) | {'yes' if s['python'] else 'no'} |")
        details.append(f"## {name}\n")
        for ex in s["exchanges"]:
            details.append(f"* shuffle: `{ex[:150]}`")
        for scan in s["scans"]:
            details.append(f"* scan `{scan[0]}`{' (bucketed)' if scan[3] else ''}: read `{scan[1]}`"
                           + (f"; pushed `{scan[2]}`" if scan[2] else ""))
        details.append("")
    out += ["", *details]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("wrote PLANS.md")


if __name__ == "__main__":
    main(sys.argv)
