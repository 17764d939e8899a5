"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query is warmed up once and then run RUNS times; its figure is the median. Results go
to a sink that keeps nothing, so that all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import catalog  # noqa: E402
from tessera.session import build  # noqa: E402

HEADLINE = ("bench_workload", "regional_daily", "origin_destination", "daily_share", "daily_kpi", "reject_listing", "dedup_lines", "canonical_keys", "dq_rules", "tumbling_windows", "last_version", "order_statistics")
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        took = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        times[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
