"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the local threads.  Each
query is built and run in full (no-op sink): one warm-up, then the median of up to
``BENCH_RUNS`` runs, fewer where these take longer than ``BENCH_SECONDS`` together.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from ringlake.registry import QUERIES  # noqa: E402
from ringlake.session import build_session  # noqa: E402

HEADLINE = [
    "silver_subscriptions", "silver_subscriptions_burst", "registration_burst", "event_burst",
    "dim_subscriptions", "fact_daily", "customer_behavior", "customer_latest_package",
    "daily_kpis", "rolling_anomaly", "daily_summary", "package_top5", "dq_report", "contract_unique",
    "bronze_land_roundtrip", "silver_table_roundtrip", "silver_stream_ingest", "refreshed_tables",
]


def seconds(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_seconds(spark, query, folder: str, runs: int, budget: float) -> float:
    seconds(spark, query, folder)
    taken: list[float] = []
    while len(taken) < runs and sum(taken) < budget:
        taken.append(seconds(spark, query, folder))
    return round(statistics.median(taken), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    budget = float(os.environ.get("BENCH_SECONDS", "8"))
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_ui_enabled="false",
        spark_driver_memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed: dict[str, float] = {}
    for name in chosen:
        timed[name] = median_seconds(spark, QUERIES[name], folder, runs, budget)
        print(f"{name}: {timed[name]}", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
