"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times (default 3); the median counts. Results
go to Spark's no-op sink, so every row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from assaylake.registry.queries import QUERIES
from assaylake.session import lake_session

HEADLINE = (
    "raw_scan",
    "silver_typed",
    "silver_dedup",
    "silver_valid",
    "silver_rejects",
    "silver_roundtrip",
    "layer_counts",
    "region_risk",
    "region_risk_raw",
    "sales_only",
    "latest_sale_per_address",
    "top_receiving_sales",
    "gold_fraud_credit",
    "catalog_gold_tables",
    "dist_anomaly",
    "dist_region",
    "duplicate_keys",
    "dq_not_null",
    "dq_in_set",
    "dq_regex",
    "dq_conditional_rules",
    "dq_compound_unique",
    "dq_suite",
    "dq_failed",
    "dq_report_json",
    "flatten_records",
    "lake_run_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = lake_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
