"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores), BENCH_RUNS (default 2,
the best one counts) and BENCH_QUERIES (comma-separated names) can be set in the environment.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from larder.plans.queries import QUERIES  # noqa: E402
from larder.session import local_session, scratch  # noqa: E402

HEADLINE = [
    "region_kpis",
    "violation_report",
    "enrich_left",
    "group_median_fit",
    "lag_features",
    "rolling_std",
    "feature_frame",
    "metric_suite",
    "sliced_metrics",
    "fold_metrics",
    "sku_profile",
    "policy_replay",
    "scenario_outcome",
    "feature_drift",
    "adaptive_loop",
    "feedback_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS") or os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cores, "larder-bench", shuffle_partitions=cores)
    times: dict[str, float] = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            # Every row is produced, none is sent to the driver.
            with scratch(spark):
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, best of runs, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
