"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query is run in
full into a sink that drops the rows.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from palimpsest.plans.queries import all_queries

# The scenarios a snapshot warehouse is judged by: build, load, same-date retry, late
# repair, backfill, look-up and checks.
HEADLINE = (
    "stage_registry",
    "scd2_events",
    "scd2_orders",
    "scd2_registry",
    "scd2_incremental",
    "snapshot_merge",
    "repair_keys",
    "as_of_join",
    "address_changes",
    "status_history",
    "quality_summary",
    "dq_overlaps",
    "dq_overlaps_linear",
    "dq_suite",
    "csv_round_trip",
    "load_raw",
    "reload_idempotent",
    "backfill",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    queries = all_queries()
    # One small query first, so that starting the engine is not charged to any of them.
    queries["scd2_events"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
