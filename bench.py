"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: threads; BENCH_QUERIES: names,
separated by commas, in place of the headline ones. Every query runs to a sink that
takes all rows and keeps none: once to warm up, then RUNS times, of which the
median counts. A query whose first run takes LONG_S seconds or more is timed once.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from riskstream.catalog.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

RUNS, LONG_S = 3, 12.0

HEADLINE = [
    "parsed_transactions",
    "rejected_records",
    "high_risk_alerts",
    "high_risk_alerts_from_raw",
    "aggregates_minute",
    "aggregates_daily",
    "sql_aggregates_minute",
    "user_bursts_minute",
    "user_bursts_daily",
    "merchant_anomalies_minute",
    "merchant_anomalies_daily",
    "fraud_alerts_daily",
    "late_events",
    "aggregate_emissions",
    "replay_records",
    "merchant_profiles",
    "profiled_high_risk_alerts",
    "topic_statistics",
    "topic_tail",
    "stream_aggregates",
    "stream_user_bursts",
    "stream_high_risk_alerts",
    "stream_emissions",
]
NAMES = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("riskstream-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds, cold = {}, {}
    for name in NAMES:
        cold[name] = round(once(name), 3)
        runs = 1 if cold[name] >= LONG_S else RUNS
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_runs": cold,
                "sf": float(scale.group(1)) if scale else None,
                "events": rows,
                "stream_events_per_sec": {
                    name: round(rows / seconds[name]) for name in seconds if name.startswith("stream_")
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
