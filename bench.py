"""Time the headline queries and print one JSON line. Each counts with the better of two runs.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores, and
BENCH_QUERIES an optional comma-separated list of query names.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from cartloom import configure
from cartloom.workload import QUERIES
from cartloom.workload.models import daily_features

HEADLINE = (
    "stg_orders",
    "stg_customers",
    "stg_order_items",
    "stg_order_payments",
    "stg_order_items_snapshot",
    "int_customer_landing",
    "int_customer_daily_features",
    "int_customer_daily_features_rows",
    "int_customer_tiers",
    "int_seller_performance",
    "snap_seller_tier_replay",
    "running_and_rolling_sums",
    "count_distinct_two",
    "data_test_report",
    # With what they store.
    "csv_ingest_report",
    "bucketed_join",
    "scd2_one_round",
    "snap_seller_tier",
    "project_row_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cartloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    # The feature table itself, not added up.
    queries = {**QUERIES, "int_customer_daily_features_rows": daily_features}

    def execute(name: str, directory: str) -> float:
        start = time.perf_counter()
        queries[name](spark, directory).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # Start the session and compile the code paths on small data first.
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            execute(name, small)
    seconds = {name: round(min(execute(name, sf_dir) for _ in range(2)), 3) for name in names}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(result))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
