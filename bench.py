"""Benchmark the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Each query is run once to warm up, then timed
BENCH_RUNS times with a no-op sink (full execution, nothing collected); the
median is reported. ``value`` is the sum of the headline medians.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from goldvein.plans.catalog import QUERIES  # noqa: E402
from goldvein.session import build_session  # noqa: E402

HEADLINE = ("silver_transactions", "silver_customers", "gold_customer_analytics", "gold_business_metrics",
            "bronze_validation")
EXTRA = ("revenue_attribution", "silver_products", "silver_sessions", "system_log_metrics", "dq_uniqueness",
         "stream_ingest_dedup", "dq_referential", "rfm_quintiles", "stream_sessions", "mrr_monthly")


def run_once(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", 2 * cpus, app_name="goldvein-bench",
                          extra={"spark.driver.memory": "8g", "spark.sql.files.maxPartitionBytes": "4m",
                                 "spark.sql.files.openCostInBytes": "256k"})
    timings: dict[str, float] = {}
    for name in HEADLINE + EXTRA:
        run_once(spark, name, sf_dir)  # warm-up
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_median_total",
        "value": round(sum(timings[n] for n in HEADLINE), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "runs": runs,
        "cpus": cpus,
        "machine": f"{platform.machine()} {os.cpu_count()} cores, local[{cpus}]",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
