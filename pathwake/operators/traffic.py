"""Funnel, traffic, item and visitor analytics on events and sessions.

Distinct visitors are counted by grouping on the visitor first and then on the reported key:
one narrow shuffle, combined map-side, and no key gathers its visitors in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.functions.columns import count_where, event_time, now_or_latest, ratio
from pathwake.schemas import CART, PURCHASE, VIEW

# Funnel windows (ms before the newest session start).
FUNNEL_WINDOWS = [("all_time", None), ("last_day", 86_400_000), ("last_month", 2_592_000_000)]


def _is(kind: str) -> Column:
    return F.col("event") == kind


def funnel_metrics(sessions: DataFrame) -> DataFrame:
    """Funnel of all sessions, of the last day and of the last 30 days.

    ``sessions`` in the state layout is read twice, once for the newest start and once for
    all three windows together; pass a stored table. No sessions, no rows.
    """
    newest = now_or_latest(sessions, "session_start", None)
    inside = {
        name: F.lit(True) if width is None else F.col("session_start") > newest - F.lit(width)
        for name, width in FUNNEL_WINDOWS
    }
    carted, bought = F.col("cart_count") > 0, F.col("transaction_count") > 0
    bought_items = F.col("transaction_count")
    totals = sessions.agg(
        *[
            F.struct(
                F.lit(name).alias("time_window"),
                count_where(test).alias("sessions"),
                count_where(test & carted).alias("cart_sessions"),
                count_where(test & bought).alias("purchase_sessions"),
                F.coalesce(F.sum(F.when(test, bought_items)), F.lit(0)).alias("total_purchases"),
            ).alias(name)
            for name, test in inside.items()
        ]
    )
    windows = F.inline(F.array(*[F.col(name) for name in inside]))
    return (
        totals.filter(F.col("all_time.sessions") > 0)
        .select(windows)
        .withColumns(
            {
                "conversion_rate": ratio(F.col("purchase_sessions"), F.col("sessions"), 100),
                "cart_abandonment": ratio(
                    F.col("cart_sessions") - F.col("purchase_sessions"),
                    F.col("cart_sessions"),
                    100,
                ),
                "avg_items_per_purchase": ratio(
                    F.col("total_purchases"), F.col("purchase_sessions")
                ),
            }
        )
    )


def funnel_json(sessions: DataFrame) -> DataFrame:
    """The funnel as one JSON object keyed by window."""
    rows = funnel_metrics(sessions)
    fields = F.struct(*[c for c in rows.columns if c != "time_window"])
    entries = F.collect_list(F.struct("time_window", fields.alias("m")))  # three rows at most
    return rows.agg(entries.alias("entries")).filter(F.size("entries") > 0).select(
        F.to_json(F.map_from_entries("entries")).alias("json")
    )


def conversion_funnel(events: DataFrame) -> DataFrame:
    """Distinct visitors per UTC day: all, viewing, carting, purchasing."""
    day = F.date_trunc("day", event_time(F.col("timestamp")))
    per_visitor = events.groupBy(day.alias("day"), "visitor_id").agg(
        F.max(_is(VIEW)).alias("viewed"),
        F.max(_is(CART)).alias("carted"),
        F.max(_is(PURCHASE)).alias("purchased"),
    )
    return (
        per_visitor.groupBy("day")
        .agg(
            F.count("visitor_id").alias("unique_visitors"),
            count_where(F.col("viewed")).alias("viewers"),
            count_where(F.col("carted")).alias("carters"),
            count_where(F.col("purchased")).alias("purchasers"),
        )
        .orderBy("day")
    )


def hourly_traffic(events: DataFrame) -> DataFrame:
    """Events and distinct visitors by UTC hour of day."""
    hour = F.hour(event_time(F.col("timestamp"))).cast("bigint")
    return (
        events.groupBy(hour.alias("hour_of_day"), "visitor_id")
        .agg(F.count("*").alias("n"))
        .groupBy("hour_of_day")
        .agg(F.sum("n").alias("event_count"), F.count("visitor_id").alias("unique_visitors"))
        .orderBy("hour_of_day")
    )


def _typed_counts() -> list[Column]:
    return [
        count_where(_is(VIEW)).alias("views"),
        count_where(_is(CART)).alias("carts"),
        count_where(_is(PURCHASE)).alias("purchases"),
        F.min("timestamp").alias("first_ms"),
        F.max("timestamp").alias("last_ms"),
    ]


def item_metrics(events: DataFrame) -> DataFrame:
    """Counts per item, distinct visitors, first and last time seen."""
    per_visitor = events.groupBy("item_id", "visitor_id").agg(*_typed_counts())
    return per_visitor.groupBy("item_id").agg(
        F.sum("views").alias("view_count"),
        F.sum("carts").alias("cart_count"),
        F.sum("purchases").alias("purchase_count"),
        F.count("visitor_id").alias("unique_visitors"),
        event_time(F.min("first_ms")).alias("first_seen"),
        event_time(F.max("last_ms")).alias("last_seen"),
    )


def visitor_metrics(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Totals per visitor from events, joined with the number of sessions."""
    per_item = events.groupBy("visitor_id", "item_id").agg(
        F.count("*").alias("n"), *_typed_counts()
    )
    activity = per_item.groupBy("visitor_id").agg(
        F.sum("n").alias("total_events"),
        F.sum("views").alias("total_views"),
        F.sum("carts").alias("total_carts"),
        F.sum("purchases").alias("total_purchases"),
        count_where((F.col("views") > 0) & F.col("item_id").isNotNull()).alias(
            "unique_items_viewed"
        ),
        event_time(F.min("first_ms")).alias("first_seen"),
        event_time(F.max("last_ms")).alias("last_seen"),
    )
    numbered = sessions.groupBy("visitor_id").agg(F.count("*").alias("total_sessions"))
    joined = activity.join(numbered, "visitor_id", "left")
    return joined.withColumn("total_sessions", F.coalesce("total_sessions", F.lit(0)))


def event_type_breakdown(events: DataFrame, size: int = 5) -> DataFrame:
    """The most frequent event types."""
    counts = events.groupBy("event").agg(F.count("*").alias("events"))
    return counts.orderBy(F.desc("events"), "event").limit(size)


def events_over_time(
    events: DataFrame,
    interval: str | None = "1 hour",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Events per time bucket within ``[start, end]``; empty buckets do not appear.

    Works on streams too. ``interval`` is any duration ``window`` takes; None chooses it from
    the range, of which a side that is not given is looked up in the events.
    """

    def ms(text: str) -> Column:  # a constant, so the filter reaches the scan
        return F.unix_millis(F.lit(text).cast("timestamp"))

    if start is not None:
        events = events.filter(F.col("timestamp") >= ms(start))
    if end is not None:
        events = events.filter(F.col("timestamp") <= ms(end))
    if interval is None:
        low, high = (events.sparkSession.range(1).select(ms(t)).first()[0] if t is not None else None for t in (start, end))
        if low is None or high is None:
            first, last = events.agg(F.min("timestamp"), F.max("timestamp")).first()
            low, high = (first or 0) if low is None else low, (last or 0) if high is None else high
        interval = auto_interval(low, high)
    timed = events.select(event_time(F.col("timestamp")).alias("event_time"))
    buckets = timed.groupBy(F.window("event_time", interval).alias("w"))
    return buckets.agg(F.count("*").alias("events")).select(
        F.col("w.start").alias("bucket"), "events"
    )


def auto_interval(start_ms: int, end_ms: int, buckets: int = 50) -> str:
    """The finest of the usual bucket widths that needs no more than ``buckets``."""
    # Usual bucket widths in seconds.
    widths = [1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10800, 43200, 86400, 604800, 2592000]
    span = max(0, end_ms - start_ms) / 1000
    fitting = [w for w in widths if span <= w * buckets]
    return f"{fitting[0] if fitting else widths[-1]} seconds"


def top_items(events: DataFrame, kind: str, size: int = 10) -> DataFrame:
    """Items with most events of one type; ties go to the smaller id."""
    counts = events.filter(_is(kind)).groupBy("item_id").agg(F.count("*").alias("events"))
    return counts.orderBy(F.desc("events"), "item_id").limit(size)


def top_viewed_items(events: DataFrame, size: int = 10) -> DataFrame:
    return top_items(events, VIEW, size)


def top_purchased_items(events: DataFrame, size: int = 10) -> DataFrame:
    return top_items(events, PURCHASE, size)


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count per named table."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
