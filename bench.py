"""Benchmark: run every query of the library on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line:
  {"metric": "total_query_seconds", "value": <sum of per-query best>, "unit": "sec",
   "queries": {name: best_sec}, "cold": {name: first_run_sec}, "sf": ..., ...}

Each query is executed in full with the no-op sink (every row computed, none
sent to the driver).  A few queries run once untimed first (JVM / JIT warm-up);
the first timed run of each query is its cold time; the value reported per
query is the best of $BENCH_RUNS runs (default 3).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from salesnet.session import get_session
    from salesnet.plans.registry import all_queries

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(4, cpus * 2)))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=parts)
    every = all_queries()
    qs = {k: v for k, v in every.items() if k in only} if only else every
    # timed once and apart from the total: the output grows with the square of the products
    apart = {k: qs[k] for k in ("product_substitution",) if k in qs}

    # JVM / JIT warm-up, not timed.
    for name in ("revenue_by_zone", "top_skus_by_units", "distributor_scorecard"):
        every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    best, cold, failed, once = {}, {}, {}, {}
    for name, fn in qs.items():
        times = []
        try:
            for _ in range(1 if name in apart else runs):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - record and keep measuring the others
            failed[name] = str(e).splitlines()[0][:200]
            continue
        if name in apart:
            once[name] = round(times[0], 3)
            continue
        cold[name] = round(times[0], 3)
        best[name] = round(min(times), 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "apart": once,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
