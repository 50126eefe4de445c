"""Write PLANS.md: the formatted physical plan (tree + scan pushdown lines) of
every registered query: python tools_explain.py [sf_dir]"""
import contextlib
import io
import sys

from docmart.plans import QUERIES
from docmart.session import local_session

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = local_session(8, 8)
out = ["# PLANS", "", f"Physical plans (`explain('formatted')`, initial AQE plan) at `{sf}`, local[8].",
       "Tree, then each scan's pushed filters and read schema. Generated by `tools_explain.py`.", ""]
for name, fn in QUERIES.items():
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        fn(spark, sf).explain("formatted")
    lines = buf.getvalue().splitlines()
    start = lines.index("== Physical Plan ==") + 1 if "== Physical Plan ==" in lines else 0
    tree = []
    for ln in lines[start:]:
        if not ln.strip():
            break
        tree.append(ln)
    tree = tree
    scans = [ln.strip() for ln in lines if ln.startswith(("PushedFilters", "ReadSchema"))]
    out += [f"## {name}", "", "```", *tree, *scans, "```", ""]
open("PLANS.md", "w").write("\n".join(out))
print("wrote PLANS.md", len(out))
