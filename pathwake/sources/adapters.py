"""Views over generic tables in the shapes the operators take.

The event views map a typed log onto visitor events; the monitoring views map
the same log, orders and line items onto lag, batch, offset and benchmark records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathwake.runtime import configure

MS = "unix_millis(CAST(ts AS TIMESTAMP))"
K = "CAST(get_json_object(props, '$.k') AS BIGINT)"
MAPPED = (
    "CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart' "
    "WHEN 'purchase' THEN 'transaction' ELSE event_type END"
)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{directory}/{name}.parquet")


def all_events(spark: SparkSession, directory: str) -> DataFrame:
    """Every logged event; types without a counterpart keep their name."""
    return table(spark, directory, "events").selectExpr(
        f"{MS} AS timestamp",
        "user_id AS visitor_id",
        f"{MAPPED} AS event",
        f"{K} AS item_id",
        "CASE WHEN event_type = 'purchase' THEN event_id END AS transaction_id",
        "event_id AS seq",
        "event_type",
    )


def clicks(spark: SparkSession, directory: str) -> DataFrame:
    """Events of the three known types."""
    known = F.col("event_type").isin("view", "click", "purchase")
    return all_events(spark, directory).filter(known).drop("event_type")


def clicks_with_copies(spark: SparkSession, directory: str) -> DataFrame:
    """Known events, every tenth repeated later with another transaction id."""
    rows = clicks(spark, directory)
    copies = rows.filter("seq % 10 = 0").selectExpr(
        "timestamp", "visitor_id", "event", "item_id",
        "CAST(-1 AS BIGINT) AS transaction_id", "seq + 1000000000000 AS seq",
    )
    return rows.unionByName(copies)


def raw_csv(spark: SparkSession, directory: str) -> DataFrame:
    """Known events in the CSV layout, transaction ids as text (empty where absent)."""
    return clicks(spark, directory).selectExpr(
        "timestamp", "visitor_id AS visitorid", "event", "item_id AS itemid",
        "coalesce(CAST(transaction_id AS STRING), '') AS transactionid", "seq",
    )


def raw_text(spark: SparkSession, directory: str) -> DataFrame:
    """All events as text with some unreadable numbers, for validation."""
    return all_events(spark, directory).selectExpr(
        "CASE WHEN seq % 11 = 0 THEN 'later' ELSE CAST(timestamp AS STRING) END AS timestamp",
        "CASE WHEN seq % 13 = 0 THEN NULL ELSE CAST(visitor_id AS STRING) END AS visitor_id",
        "event",
        "CASE WHEN seq % 17 = 0 THEN 'x7' ELSE CAST(item_id AS STRING) END AS item_id",
        "CASE WHEN seq % 19 = 0 THEN '?' ELSE CAST(transaction_id AS STRING) END "
        "AS transaction_id",
        "seq",
    )


def messages(spark: SparkSession, directory: str) -> DataFrame:
    """JSON messages: direct, under ``value``, under ``data``; some broken or incomplete."""
    body = (
        "concat('{\"timestamp\":', timestamp, ',\"visitor_id\":', visitor_id, "
        "',\"event\":\"', event, '\"', "
        "CASE WHEN seq % 7 = 0 THEN '' WHEN seq % 5 = 0 THEN ',\"item_id\":null' "
        "ELSE concat(',\"item_id\":', item_id) END, "
        "',\"transaction_id\":', coalesce(CAST(transaction_id AS STRING), 'null'), '}')"
    )
    return (
        clicks(spark, directory)
        .withColumn("body", F.expr(body))
        .selectExpr(
            "seq",
            "CASE WHEN seq % 23 = 0 THEN 'oops' WHEN seq % 3 = 1 THEN "
            "concat('{\"value\":', body, '}') WHEN seq % 3 = 2 THEN "
            "concat('{\"data\":', body, ',\"value\":5}') ELSE body END AS value",
        )
    )


def lag_samples(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "events").selectExpr(
        "event_type AS group_id", "user_id % 3 AS instance",
        f"({MS} div 3600000) * 3600 AS ts", "user_id % 3 AS part",
        "CAST(floor(value * 10) AS BIGINT) AS lag", "event_id AS seq",
    )


def batch_metrics(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "events").selectExpr(
        "event_type AS group_id", "user_id % 3 AS instance", "event_id AS batch_id",
        f"{MS} AS end_ms", f"{K} + 1 AS batch_size", "CAST(100 AS BIGINT) AS max_batch_size",
        "value AS pg_events_ms", f"CAST({K} AS DOUBLE) AS valkey_ms",
        "value / 2 AS pg_sessions_ms", f"CAST({K} * 10 AS DOUBLE) AS poll_ms",
        "value / 10 AS commit_ms",
    )


def rebalances(spark: SparkSession, directory: str) -> DataFrame:
    """Error rows stand for rebalances; two groups share them by user."""
    return table(spark, directory, "events").filter("event_type = 'error'").selectExpr(
        "CASE user_id % 2 WHEN 0 THEN 'view' ELSE 'purchase' END AS group_id",
        "user_id % 3 AS instance", f"{MS} div 1000 AS ts",
    )


def counter_samples(spark: SparkSession, directory: str) -> DataFrame:
    """Running number of events per type, sampled hourly."""
    hourly = (
        table(spark, directory, "events")
        .selectExpr("event_type AS source", f"({MS} div 3600000) * 3600 AS ts")
        .groupBy("source", "ts")
        .agg(F.count("*").alias("n"))
    )
    return hourly.selectExpr(
        "source", "ts", "sum(n) OVER (PARTITION BY source ORDER BY ts) AS count"
    )


def committed_offsets(spark: SparkSession, directory: str) -> DataFrame:
    return (
        table(spark, directory, "orders")
        .groupBy(F.col("o_orderpriority").alias("topic"), F.expr("o_custkey % 4").alias("part"))
        .agg(F.max("o_orderkey").alias("newest"))
        .selectExpr("topic", "part", "CASE WHEN part = 3 THEN -1L ELSE newest END AS committed")
    )


def end_offsets(spark: SparkSession, directory: str) -> DataFrame:
    orders = table(spark, directory, "orders")
    # Combine the items of one order before the join; it then moves one row per order.
    items = (
        table(spark, directory, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_linenumber").alias("lines"))
    )
    return (
        orders.join(items, orders.o_orderkey == items.l_orderkey)
        .groupBy(F.col("o_orderpriority").alias("topic"), F.expr("o_custkey % 4").alias("part"))
        .agg((F.max("l_orderkey") + F.sum("lines") % 7).alias("end_offset"))
    )


def ramp_samples(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "events").selectExpr(
        "event_type AS run_id", f"{MS} AS ts_ms", f"1 + {K} % 5 AS step",
        f"(1 + {K} % 5) * 1000 AS rate_target",
        "CAST(floor(value * 10) AS BIGINT) AS consumer_throughput", f"{K} * 100 AS total_lag",
        "CASE user_id % 3 WHEN 0 THEN 'stable' WHEN 1 THEN 'growing' ELSE 'shrinking' END "
        "AS lag_trend",
        "event_id AS seq",
    )


def count_samples(spark: SparkSession, directory: str) -> DataFrame:
    """Polled counts of a run; a failed poll reads -1, and counts stand still at times."""
    return table(spark, directory, "events").selectExpr(
        "event_type AS run_id", f"{MS} AS ts_ms", f"1 + {K} % 5 AS step",
        f"CASE WHEN {K} = 0 THEN -1 ELSE event_id - event_id % 2000 END AS count",
        "event_id AS seq",
    )


def bench_runs(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "events").selectExpr(
        f"{MS} AS ts_ms", "CASE user_id % 2 WHEN 0 THEN 'local' ELSE 'cloud' END AS environment",
        "event_type AS impl", "1 + user_id % 4 AS partitions", f"{K} * 100 AS events_consumed",
        f"1 + {K} AS duration_sec", "CAST(floor(value * 100) AS BIGINT) AS throughput",
    )
