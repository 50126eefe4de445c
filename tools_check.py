"""Run registered queries against their DuckDB oracles: python tools_check.py [sf_dir] [names...]"""
import json
import sys
import time

from docmart.plans import QUERIES
from docmart.plans.compare import compare
from docmart.session import local_session

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(QUERIES)
spark = local_session(8)
for n in names:
    t = time.time()
    try:
        r = compare(spark, n, sf)
    except Exception as e:  # report and continue
        r = {"query": n, "error": repr(e)[:800]}
    r["sec"] = round(time.time() - t, 2)
    print(json.dumps(r), flush=True)
