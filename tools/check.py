"""Run registry queries against their DuckDB oracles: python tools/check.py [sf_dir] [names...]"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zoneflow.plans import oracle_check, registry  # noqa: E402
from zoneflow.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
registry.load_all()
spark = local_session(8)
bad = 0
for name, fn in registry.QUERIES.items():
    if names and name not in names:
        continue
    t = time.time()
    try:
        r = oracle_check.compare(spark, name, fn, registry.ORACLE.get(name), sf)
    except Exception as e:  # report and continue
        r = {"query": name, "status": f"error {type(e).__name__}: {str(e)[:600]}"}
    r["sec"] = round(time.time() - t, 2)
    if r["status"] not in ("match", "rows-only"):
        bad += 1
    print(json.dumps(r, default=str)[:1500], flush=True)
print("BAD", bad)
