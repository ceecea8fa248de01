"""Benchmark the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4),
BENCH_RUNS (default 3). Each query: one discarded warm-up, then the median of
BENCH_RUNS runs; a run builds the DataFrame and forces every row with a
``noop`` write (full execution, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q_flags", "q_comfort", "q_hourly_daily", "q_band_join", "q_streaks", "q_extreme_events",
    "q_anomaly", "q_month_summary", "q_season_summary", "q_city_summary", "q_forecast_error",
    "q_ranking", "q_planner", "q_nearest", "q_proxy_estimate", "q_payload", "q_slug",
    "q_dq_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in sys.argv[1:] if not q.startswith("-")]

    from dayframe.plans.queries import QUERIES
    from dayframe.session import get_spark

    # spark.checkpoint.dir comes from the cluster config; get_spark only
    # fills it in when unset
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")}
    spark = get_spark(f"local[{cpus}]", max(8, 2 * cpus), "dayframe-bench", extra)

    names = only or HEADLINE
    timings: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        timings[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
