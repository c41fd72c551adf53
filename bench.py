"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced to completion with the ``noop`` writer (every row is
computed, nothing is collected), once as warm-up and then ``BENCH_REPEAT``
times; the per-query figure is the median. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "monthly_revenue", "revenue_growth", "top_summary", "failed_payment_pct", "gateway_health",
    "cohort_revenue_raw", "cohort_retention", "cohort_lifetime", "failure_monitor", "retry_summary",
    "duplicate_transactions", "stale_pending", "revenue_leakage", "run_all",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]

    from ledgerlens.plans.registry import QUERIES
    from ledgerlens.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for k in keys:
        fn = QUERIES[k]
        runs = []
        try:
            for i in range(repeat + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:  # first run is the warm-up
                    runs.append(time.perf_counter() - t0)
            times[k] = round(statistics.median(runs), 4)
        except Exception as exc:  # noqa: BLE001 - report the failure, keep benchmarking the rest
            errors[k] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = os.path.basename(sf_dir).removeprefix("sf")
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf
    out = {"metric": "headline_total_median_sec", "value": round(sum(times.values()), 4),
           "unit": "sec", "queries": times, "sf": sf_val, "cpus": cpus, "repeat": repeat}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
