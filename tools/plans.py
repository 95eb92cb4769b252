"""Summarize the physical plans of registry queries into PLANS.md.

python tools/plans.py [sf_dir] [names...]

For each query: number of shuffles (Exchange), join strategies, whether
windows run with a per-partition group limit, and for every parquet scan
its ReadSchema and PushedFilters.  The plan is the pre-execution
(AdaptiveSparkPlan initial) plan; AQE may still switch a sort-merge join to
a broadcast join at run time when the measured side is small.
"""

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zoneflow.plans import registry  # noqa: E402
from zoneflow.session import local_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def summarize(plan: str) -> dict:
    tree = plan.split("\n\n")[0]
    ops = Counter(re.findall(r"([A-Za-z]+(?: [A-Za-z]+)?) \(\d+\)", tree))
    scans = []
    for block in re.findall(r"\(\d+\) Scan parquet.*?(?=\n\(\d+\)|\Z)", plan, re.S):
        loc = re.search(r"Location: \w+ \[([^\]]*)\]", block)
        pf = re.search(r"PushedFilters: \[(.*)\]", block)
        rs = re.search(r"ReadSchema: (.*)", block)
        table = os.path.basename(loc.group(1).split(",")[0]) if loc else "?"
        scans.append((table, pf.group(1) if pf else "", rs.group(1) if rs else ""))
    joins = {j: len(re.findall(rf"\b{j}\b", tree)) for j in JOINS}
    return {
        "exchanges": len(re.findall(r"\bExchange \(\d+\)", tree)),
        "joins": {j: n for j, n in joins.items() if n},
        "group_limit": ops.get("WindowGroupLimit", 0),
        "windows": ops.get("Window", 0),
        "scans": scans,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    registry.load_all()
    spark = local_session(8)
    out = ["# PLANS", "", f"Physical plans of the registry queries (`tools/plans.py`, {sf}). "
           "Exchanges = shuffles in the initial plan; joins by strategy; scans with pushed filters "
           "and the columns actually read.", ""]
    for name, fn in registry.QUERIES.items():
        if names and name not in names:
            continue
        df = fn(spark, sf)
        import io
        from contextlib import redirect_stdout

        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        s = summarize(buf.getvalue())
        out.append(f"## {name}")
        out.append(f"- shuffles: {s['exchanges']}; joins: {s['joins'] or 'none'}; windows: {s['windows']} (group-limited: {s['group_limit']})")
        for t, pf, rs in s["scans"]:
            out.append(f"- scan `{t}` read `{rs}`" + (f" pushed `{pf}`" if pf else ""))
        out.append("")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("\n".join(out))


if __name__ == "__main__":
    main()
