"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into the `noop` sink (no driver collect);
one warm-up pass, then $BENCH_REPEATS timed passes; a query's time is the
median of its passes.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from docmart.plans import QUERIES
    from docmart.session import local_session

    spark = local_session(cpus, shuffle_partitions=cpus, app="docmart-bench")
    names = only or list(QUERIES)

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for n in names:          # warm-up: JIT, file listing caches, python imports
        run(n)
    times = {n: [] for n in names}
    for _ in range(repeats):
        for n in names:
            times[n].append(run(n))
    per_query = {n: round(statistics.median(v), 3) for n, v in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
