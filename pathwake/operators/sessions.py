"""Inactivity-based sessions.

A new session starts where the gap to the visitor's previous event exceeds the timeout; a
gap equal to it does not. Sessions are numbered per visitor from 1 and carry counters and
the distinct items in first-seen order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathwake.functions.columns import count_where, event_time
from pathwake.operators.events import dedup_events
from pathwake.operators.skew import HEAVY_ROWS, null_safe_join, split_heavy
from pathwake.schemas import (
    CART,
    PURCHASE,
    SESSION_TIMEOUT_MS,
    STATE,
    STATE_TTL_MS,
    VIEW,
)

# Typed columns per event type: counter, item list.
TYPED = {
    VIEW: ("view_count", "items_viewed"),
    CART: ("cart_count", "items_carted"),
    PURCHASE: ("transaction_count", "items_purchased"),
}
COUNTERS = ["event_count"] + [counter for counter, _ in TYPED.values()]
ITEM_LISTS = [items for _, items in TYPED.values()]


def sessionize(
    events: DataFrame,
    timeout_ms: int = SESSION_TIMEOUT_MS,
    dedupe: bool = False,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Sessions of all visitors in the state layout (times in ms).

    ``seq`` (arrival order) breaks ties of equal timestamps when the column exists.
    Duplicate events count unless ``dedupe``.

    Visitors of ordinary size take one shuffle on ``visitor_id``. Visitors above
    ``heavy_rows`` events are combined map-side first, see :func:`_heavy_sessions`.
    """
    received = events  # an upper bound of what is left of a visitor without duplicates
    if dedupe:
        events = dedup_events(events)
    seq = F.col("seq") if "seq" in events.columns else F.lit(0).cast("bigint")
    rows = events.select("visitor_id", "timestamp", "event", "item_id", seq.alias("seq"))
    ordinary, heavy = split_heavy(rows, "visitor_id", heavy_rows, received)
    sessions = _ordinary_sessions(ordinary, timeout_ms)
    if heavy is not None:
        sessions = sessions.unionByName(_heavy_sessions(heavy, timeout_ms))
    return sessions


def _ordinary_sessions(rows: DataFrame, timeout_ms: int) -> DataFrame:
    """Window over the visitor, then two aggregations on the same partitioning."""
    order = W.partitionBy("visitor_id").orderBy("timestamp", "seq", "event", "item_id")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    gap = F.col("timestamp") - F.lag("timestamp").over(order)
    numbered = (
        rows.withColumn("opens", F.when(gap > timeout_ms, 1).otherwise(0))
        .withColumn("session_num", F.sum("opens").over(so_far) + 1)
        .withColumn("first_at", F.row_number().over(order))
    )
    per_item = numbered.groupBy("visitor_id", "session_num", "event", "item_id").agg(
        F.count("*").alias("n"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.min("first_at").alias("first_at"),
    )
    return _fold_items(per_item)


def _heavy_sessions(rows: DataFrame, timeout_ms: int) -> DataFrame:
    """Sessions of visitors whose events do not fit one task.

    Events within one time slot of ``timeout + 1`` ms always belong to one session, so they
    are combined per slot, event and item before any shuffle. The window over a visitor then
    sees one row per slot: at most the covered time divided by the timeout, however many
    events there are. Item lists are built from the combined rows, never from the events.
    """
    slot = F.floor(F.col("timestamp") / (timeout_ms + 1)).cast("bigint")
    combined = (
        rows.withColumn("slot", slot)
        .groupBy("visitor_id", "slot", "event", "item_id")
        .agg(
            F.count("*").alias("n"),
            F.min("timestamp").alias("first_ts"),
            F.max("timestamp").alias("last_ts"),
            F.min(F.struct("timestamp", "seq")).alias("first_at"),
        )
    )
    order = W.partitionBy("visitor_id").orderBy("slot")
    slots = (
        combined.groupBy("visitor_id", "slot")
        .agg(F.min("first_ts").alias("slot_start"), F.max("last_ts").alias("slot_end"))
        .withColumn("gap", F.col("slot_start") - F.lag("slot_end").over(order))
        .withColumn("opens", F.when(F.col("gap") > timeout_ms, 1).otherwise(0))
        .withColumn("session_num", F.sum("opens").over(order) + 1)
        .select("visitor_id", "slot", "session_num")
    )
    per_item = (
        null_safe_join(combined, slots, ["visitor_id", "slot"])
        .groupBy("visitor_id", "session_num", "event", "item_id")
        .agg(
            F.sum("n").alias("n"),
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.min("first_at").alias("first_at"),
        )
    )
    return _fold_items(per_item)


def _fold_items(per_item: DataFrame) -> DataFrame:
    """One row per session from rows per session, event type and item."""

    def items(kind: str) -> Column:
        seen = F.when(F.col("event") == kind, F.struct("first_at", "item_id"))
        return F.transform(F.array_sort(F.collect_list(seen)), lambda x: x["item_id"])

    def counter(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("event") == kind, F.col("n"))), F.lit(0))

    sessions = per_item.groupBy("visitor_id", "session_num").agg(
        F.min("first_ts").alias("session_start"),
        F.max("last_ts").alias("session_end"),
        F.sum("n").alias("event_count"),
        *[counter(kind).alias(name) for kind, (name, _) in TYPED.items()],
        *[items(kind).alias(name) for kind, (_, name) in TYPED.items()],
    )
    return _in_state_layout(sessions.withColumn("last_activity", F.col("session_end")))


def session_id() -> Column:
    return F.concat_ws("_", "visitor_id", "session_num")


def _in_state_layout(sessions: DataFrame) -> DataFrame:
    named = sessions.withColumn("session_id", session_id())
    return named.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in STATE])


def to_table(sessions: DataFrame) -> DataFrame:
    """State layout to the session table: UTC times, whole-second duration, conversion flag."""
    return sessions.select(
        "session_id",
        "visitor_id",
        event_time(F.col("session_start")).alias("session_start"),
        event_time(F.col("session_end")).alias("session_end"),
        F.expr("(session_end - session_start) div 1000").alias("duration_seconds"),
        *COUNTERS,
        *ITEM_LISTS,
        (F.col("transaction_count") > 0).alias("converted"),
    )


def session_item_sets(sessions: DataFrame) -> DataFrame:
    """Items per session as sorted sets."""
    return sessions.select(
        "session_id", "visitor_id", *[F.array_sort(c).alias(c) for c in ITEM_LISTS]
    )


def resume_sessions(
    events: DataFrame,
    state: DataFrame,
    timeout_ms: int = SESSION_TIMEOUT_MS,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Sessions changed or opened by ``events``, given one stored state row per visitor.

    The first session of the batch continues the stored one unless the gap exceeds the
    timeout; a late first event (negative gap) continues it too, and then neither raises nor
    lowers the stored start. Every session of the batch is returned.
    """
    fresh = sessionize(events, timeout_ms, heavy_rows=heavy_rows)
    old = state.select("visitor_id", *[F.col(f.name).alias(f"old_{f.name}") for f in STATE
                                       if f.name not in ("visitor_id", "session_id")])
    opening = F.min("session_start").over(W.partitionBy("visitor_id"))
    joined = fresh.withColumn("opening", opening).join(old, "visitor_id", "left")
    continues = F.coalesce(
        (F.col("old_last_activity") != 0)
        & (F.col("opening") - F.col("old_last_activity") <= timeout_ms),
        F.lit(False),
    )
    offset = F.coalesce(F.col("old_session_num"), F.lit(0)) - F.when(continues, 1).otherwise(0)
    joined = joined.withColumn("merged", continues & (F.col("session_num") == 1)).withColumn(
        "session_num", F.col("session_num") + offset
    )

    def merged(both: Column, name: str) -> Column:
        return F.when(F.col("merged"), both).otherwise(F.col(name)).alias(name)

    result = joined.select(
        "visitor_id",
        "session_num",
        merged(F.col("old_session_start"), "session_start"),
        merged(F.greatest("old_session_end", "session_end"), "session_end"),
        *[merged(F.col(f"old_{c}") + F.col(c), c) for c in COUNTERS],
        *[merged(F.array_union(f"old_{c}", c), c) for c in ITEM_LISTS],
        "last_activity",
    )
    return _in_state_layout(result)


def latest_state(sessions: DataFrame) -> DataFrame:
    """The state row to keep per visitor: its highest-numbered session."""
    fields = [f.name for f in STATE if f.name != "visitor_id"]
    newest = F.max_by(F.struct(*fields), "session_num").alias("s")
    return sessions.groupBy("visitor_id").agg(newest).select(
        *[F.col("visitor_id") if f.name == "visitor_id" else F.col(f"s.{f.name}") for f in STATE]
    )


def state_to_text(state: DataFrame) -> DataFrame:
    """State as a hash of strings, lists as JSON text (the stored key-value form)."""
    return state.select(
        [
            (F.to_json(f.name) if f.name in ITEM_LISTS else F.col(f.name).cast("string")).alias(
                f.name
            )
            for f in STATE
        ]
    )


def state_from_text(text: DataFrame) -> DataFrame:
    """Inverse of :func:`state_to_text`; missing numbers read as 0, missing lists as empty."""

    def read(field):
        column = F.col(field.name)
        if field.name in ITEM_LISTS:
            return F.from_json(F.coalesce(column, F.lit("[]")), "array<bigint>")
        if field.name == "session_id":
            return column
        default = 1 if field.name == "session_num" else 0
        return F.coalesce(column.cast("bigint"), F.lit(default).cast("bigint"))

    return text.select([read(f).alias(f.name) for f in STATE])


def active_sessions(
    state: DataFrame, as_of: Column, ttl_ms: int = STATE_TTL_MS, written: str = "last_activity"
) -> DataFrame:
    """Number of state rows whose time to live has not run out at ``as_of`` (ms)."""
    alive = count_where(F.col(written) > as_of - F.lit(ttl_ms))
    return state.agg(alive.alias("active_sessions"))
