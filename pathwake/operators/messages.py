"""Messages: events as keyed JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.schemas import EVENT, REQUIRED_FIELDS

EVENT_FIELDS = [f.name for f in EVENT]


def publish_events(events: DataFrame, topic: str = "events", partitions: int = 3) -> DataFrame:
    """Message rows: key is the visitor, value JSON with explicit nulls.

    ``partition`` depends on the key alone, so a visitor's messages stay in one partition;
    it is computed in place and moves no data.
    """
    value = F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false"})
    key = F.col("visitor_id").cast("string")
    return events.select(
        key.alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int").alias("partition"),
        *[c for c in ("seq",) if c in events.columns],
    )


def decode_messages(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Event columns from the JSON ``value``; message columns are kept.

    Messages with a transport ``error`` are dropped. Unreadable JSON is kept with its text in
    ``corrupt`` for quarantine, or fails the query when ``strict``.
    """
    if "error" in messages.columns:
        messages = messages.filter(F.col("error").isNull()).drop("error")
    kept = [c for c in messages.columns if c != "timestamp"]
    if strict:
        parsed = F.from_json("value", EVENT, {"mode": "FAILFAST"})
        return messages.select(*kept, parsed.alias("e")).select(
            *kept, *[F.col(f"e.{c}").alias(c) for c in EVENT_FIELDS]
        )
    layout = f"{_ddl()}, corrupt string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    parsed = F.from_json("value", layout, options)
    # JSON that is readable but not an object yields no field at all; only then look again.
    empty = F.coalesce(*[F.col(f"e.{c}").cast("string") for c in EVENT_FIELDS]).isNull()
    no_object = F.when(empty, F.when(~_is_object("value"), F.col("value")))
    broken = F.coalesce(F.col("e.corrupt"), no_object)
    return _computed_once(messages, "e", parsed).select(
        *kept, *[F.col(f"e.{c}").alias(c) for c in EVENT_FIELDS], broken.alias("corrupt")
    )


def readable(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("corrupt").isNull()).drop("corrupt")


def unwrap_messages(messages: DataFrame) -> DataFrame:
    """Event objects from messages that hold them directly, under ``value`` or under ``data``.

    A branch counts only when it is an object. Messages lacking a required field are dropped;
    a field that is present with a JSON null passes. The text is parsed once.
    """

    def as_object(variant: Column) -> Column:
        return variant.try_cast("map<string,variant>")  # null unless it is an object

    whole = as_object(F.try_parse_json("value"))
    inner, outer = as_object(F.col("whole")["value"]), as_object(F.col("whole")["data"])
    complete = F.lit(True)
    for name in REQUIRED_FIELDS:
        complete = complete & F.map_contains_key("body", name)
    parsed = _computed_once(messages, "whole", whole)
    return (
        _computed_once(parsed, "body", F.coalesce(inner, outer, F.col("whole")))
        .filter(complete)
        .select(
            *[c for c in messages.columns if c not in ("value", "timestamp")],
            *[F.col("body")[f.name].try_cast(f.dataType).alias(f.name) for f in EVENT],
        )
    )


def _computed_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a costly column that later filters use.

    A plain column would be computed again in every filter moved below it; the output of a
    generator is not.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))


def _ddl() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENT)


def _is_object(column: str) -> Column:
    return F.coalesce(F.json_object_keys(column).isNotNull(), F.lit(False))
