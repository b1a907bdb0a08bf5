"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs after one warm-up, default 3; the median is reported),
BENCH_QUERIES (comma-separated subset), BENCH_SHUFFLE_PARTITIONS (default 2 x cpus). Each query is executed in full with the
``noop`` sink, so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.registry import QUERIES, load_all  # noqa: E402
from strata.session import local_session  # noqa: E402

HEADLINE = [
    "silver_prices", "gold_latest_prices", "gold_price_summary", "gold_market_dominance",
    "silver_hrrp", "gold_hospital_summary", "gold_state_summary", "gold_condition_summary",
    "stg_carbon_intensity", "stg_generation_mix", "int_regional_metrics", "int_time_features",
    "mart_carbon_intensity", "mart_generation_mix", "mart_peak_analysis", "mart_regional_comparison",
    "dq_report", "dedupe_polls", "dense_rank_scaled", "stream_movement",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    load_all()
    spark = local_session("strata-bench", cpus, extra={
        "spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(int(cpus), 1) * 2)),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
    })
    times = {}
    for name in wanted:
        run_once(spark, name, sf_dir)  # warm-up
        samples = [run_once(spark, name, sf_dir) for _ in range(runs)]
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
