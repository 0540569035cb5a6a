"""Record layouts shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types, message fields and defaults of the data model.
VIEW, CART, PURCHASE = "view", "addtocart", "transaction"
EVENT_TYPES = [VIEW, CART, PURCHASE]
REQUIRED_FIELDS = ["timestamp", "visitor_id", "event", "item_id"]
EVENT_KEY = ["visitor_id", "timestamp", "event", "item_id"]
SESSION_TIMEOUT_MS = 30 * 60 * 1000
STATE_TTL_MS = 24 * 60 * 60 * 1000


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_LONG, _TEXT, _DOUBLE, _TIME = T.LongType(), T.StringType(), T.DoubleType(), T.TimestampType()
_ITEMS = T.ArrayType(_LONG)

RAW_CSV = _struct(
    ("timestamp", _LONG),
    ("visitorid", _LONG),
    ("event", _TEXT),
    ("itemid", _LONG),
    ("transactionid", _TEXT),
)

EVENT = _struct(
    ("timestamp", _LONG),
    ("visitor_id", _LONG),
    ("event", _TEXT),
    ("item_id", _LONG),
    ("transaction_id", _LONG),
)

EVENT_TABLE = _struct(
    ("event_time", _TIME),
    ("visitor_id", _LONG),
    ("event", _TEXT),
    ("item_id", _LONG),
    ("transaction_id", _LONG),
)

STATE = _struct(
    ("session_id", _TEXT),
    ("visitor_id", _LONG),
    ("session_num", _LONG),
    ("session_start", _LONG),
    ("session_end", _LONG),
    ("event_count", _LONG),
    ("view_count", _LONG),
    ("cart_count", _LONG),
    ("transaction_count", _LONG),
    ("items_viewed", _ITEMS),
    ("items_carted", _ITEMS),
    ("items_purchased", _ITEMS),
    ("last_activity", _LONG),
)

SESSION_TABLE = _struct(
    ("session_id", _TEXT),
    ("visitor_id", _LONG),
    ("session_start", _TIME),
    ("session_end", _TIME),
    ("duration_seconds", _LONG),
    ("event_count", _LONG),
    ("view_count", _LONG),
    ("cart_count", _LONG),
    ("transaction_count", _LONG),
    ("items_viewed", _ITEMS),
    ("items_carted", _ITEMS),
    ("items_purchased", _ITEMS),
    ("converted", T.BooleanType()),
)

# Stored forms: with what orders the versions of a row.
_MOMENT = _struct(("session_end", _TIME), ("event_count", _LONG), ("stream_id", _TEXT))
STORED_EVENT = T.StructType([*EVENT, T.StructField("event_date", T.DateType())])
STORED_SESSION = T.StructType([
    *SESSION_TABLE, T.StructField("born", _MOMENT), T.StructField("version", _MOMENT)
])
STORED_DOCUMENT = _struct(
    ("doc_id", _TEXT),
    ("event_time", _TEXT),
    ("timestamp", _LONG),
    ("visitor_id", _LONG),
    ("event", _TEXT),
    ("item_id", _LONG),
    ("transaction_id", _LONG),
    ("version", _struct(("stream_id", _TEXT), ("batch_id", _LONG))),
)

ITEM_METRICS = _struct(
    ("item_id", _LONG),
    ("view_count", _LONG),
    ("cart_count", _LONG),
    ("purchase_count", _LONG),
    ("unique_visitors", _LONG),
    ("first_seen", _TIME),
    ("last_seen", _TIME),
)

VISITOR_METRICS = _struct(
    ("visitor_id", _LONG),
    ("total_sessions", _LONG),
    ("total_events", _LONG),
    ("total_views", _LONG),
    ("total_carts", _LONG),
    ("total_purchases", _LONG),
    ("unique_items_viewed", _LONG),
    ("first_seen", _TIME),
    ("last_seen", _TIME),
)

MESSAGE = _struct(
    ("key", _TEXT),
    ("value", _TEXT),
    ("topic", _TEXT),
    ("partition", T.IntegerType()),
    ("offset", _LONG),
    ("timestamp", _TIME),
    ("headers", T.ArrayType(_struct(("key", _TEXT), ("value", T.BinaryType())))),
)

RUN_RESULT = _struct(
    ("timestamp", _TEXT),
    ("environment", _TEXT),
    ("consumer_impl", _TEXT),
    ("partitions", _LONG),
    ("events_produced", _LONG),
    ("events_consumed", _LONG),
    ("duration_sec", _LONG),
    ("throughput_events_sec", _LONG),
)

RAMP_RESULT = _struct(
    ("timestamp", _TEXT),
    ("run_id", _TEXT),
    ("consumer_impl", _TEXT),
    ("step", _LONG),
    ("rate_target", _LONG),
    ("consumer_throughput", _LONG),
    ("total_lag", _LONG),
    ("lag_trend", _TEXT),
)
