"""Benchmark the headline queries.

Runs every gold table plus the account spine, the subscription history,
the data-quality report and one full production run (all gold tables written) on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``. Each query is executed in full through the
``noop`` sink (no rows are collected to the driver): one warm-up, then
``$BENCH_RUNS`` (default 3) timed runs; the median is reported. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.context import build_session, scratch_path  # noqa: E402
from tidemark.plans import catalog  # noqa: E402
from tidemark.plans.pipeline import Pipeline  # noqa: E402

HEADLINE = [
    "gold_account_health_summary",
    "gold_customer_segments",
    "gold_churn_analysis",
    "gold_mrr_trends",
    "gold_feature_adoption",
    "gold_support_performance",
    "int_account_360",
    "snap_subscriptions_scd2",
    "dq_report",
    "pipeline_run",  # all six gold tables written, spine materialized once (the production run)
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    if name == "pipeline_run":
        Pipeline.from_driver_tables(spark, sf_dir).run(scratch_path(spark, "bench-gold"))
    else:
        catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app_name="tidemark-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")})
    results = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up
        results[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
