"""Times the headline queries and prints one JSON line.

Each query runs to its last row into a sink that discards them, so nothing is collected. The best of a
few runs counts; all runs are over whole tables. One untimed run of the mart warms the JVM up first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattledger.plans import catalog  # noqa: E402
from wattledger.session import local_session  # noqa: E402

HEADLINE = (
    "latest_reading",
    "effective_meter",
    "usage_monthly",
    "rack_monthly",
    "erp_revenue_monthly",
    "power_cost_allocated",
    "mart_contract_monthly",
    "controls_data_integrity",
    "controls_summary",
    "exceptions_only",
    "customer_monthly",
    "missing_readings",
    "lateness_class",
    "version_reattribution",
    "mrr_vs_invoiced",
    "variance_root_cause",
    "stale_version_billing",
    "pk_violations",
    "backfill_merge",
    "unbilled_spikes",
    "layer_row_counts",
    "mart_partition_overwrite",
    "stream_usage_daily",
)


def _run(spark, query, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(
        cores, 8, **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"), "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.queries()
    _run(spark, registered["mart_contract_monthly"], sf_dir)
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(min(_run(spark, registered[name], sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
