"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up (default 3)
BENCH_QUERIES  comma-separated names instead of the headline ones, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pathwake.plans.catalog import QUERIES  # noqa: E402
from pathwake.runtime import configure  # noqa: E402

HEADLINE = [
    "dedup_events", "insert_new_events", "sessionize", "sessionize_12h", "sessionize_heavy",
    "sessionize_copies", "resume_sessions", "upsert_sessions", "funnel_metrics",
    "conversion_funnel", "hourly_traffic", "item_metrics", "visitor_metrics",
    "event_type_breakdown", "events_over_time", "top_viewed_items", "top_purchased_items",
    "decode_messages", "unwrap_messages", "index_documents", "consumer_lag", "lag_history",
    "lag_trend", "lag_trend_rolling", "batch_summary", "batch_indicators",
    "backpressure_report", "stage_trend_rolling", "ramp_steps", "ramp_saturation",
    "sample_throughput", "stall_detection", "bench_summary", "replay_schedule",
    "rate_limited_schedule", "status_overview",
]
STREAMS = ["stream_events_table", "stream_sessions", "stream_documents"]
# Queries whose events per second are reported: events in over seconds.
RATES = ["dedup_events", "sessionize", "stream_sessions"]


def timed(spark: SparkSession, name: str, directory: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [q for q in chosen.split(",") if q]
    names = names or HEADLINE + STREAMS
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    events = spark.read.parquet(f"{directory}/events.parquet")
    known = events.filter("event_type IN ('view', 'click', 'purchase')").count()
    seconds = {}
    for name in names:
        repeat = 1 if name.startswith("stream") else runs
        timed(spark, name, directory)
        seconds[name] = round(
            statistics.median(timed(spark, name, directory) for _ in range(repeat)), 3
        )
    result = {
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "events_per_sec": {n: round(known / seconds[n]) for n in RATES if n in seconds},
        "sf": os.path.basename(directory.rstrip("/")),
        "cpus": int(cpus),
        "spark": spark.version,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "runs": runs,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
