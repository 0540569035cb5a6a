"""Event rows: normalising, validating, de-duplicating and shaping for the sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.functions.columns import document_id, event_time, iso_text, optional_id
from pathwake.schemas import EVENT, EVENT_KEY, EVENT_TYPES


def normalize_events(raw: DataFrame) -> DataFrame:
    """Columns of the CSV layout to the event layout, plus ``event_time`` in UTC."""
    renamed = raw.withColumnsRenamed(
        {"visitorid": "visitor_id", "itemid": "item_id", "transactionid": "transaction_id"}
    )
    return renamed.withColumns(
        {
            "transaction_id": optional_id(F.col("transaction_id").cast("string")),
            "event_time": event_time(F.col("timestamp")),
        }
    )


def validate_events(raw: DataFrame) -> DataFrame:
    """Check text or typed rows; adds ``reasons`` (failed columns) and ``is_valid``.

    Numbers are read with ``try_cast``; required columns must be present and readable, the
    event must be a known type, the transaction id may be absent but not unreadable.
    """

    def readable(name: str) -> Column:
        return F.col(name).try_cast("bigint").isNotNull()

    failed = [
        F.when(~readable("timestamp"), "timestamp"),
        F.when(~readable("visitor_id"), "visitor_id"),
        F.when(~F.coalesce(F.col("event").isin(EVENT_TYPES), F.lit(False)), "event"),
        F.when(~readable("item_id"), "item_id"),
        F.when(
            F.col("transaction_id").isNotNull() & ~readable("transaction_id"), "transaction_id"
        ),
    ]
    checked = raw.withColumn("reasons", F.array_compact(F.array(*failed)))
    return checked.withColumn("is_valid", F.size("reasons") == 0)


def typed(rows: DataFrame) -> DataFrame:
    """Cast the event columns of valid rows; other columns pass through."""
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in EVENT}
    return rows.withColumns(casts)


def split_valid_rejected(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed valid rows, and rejected rows with their reasons."""
    checked = validate_events(raw)
    valid = typed(checked.filter("is_valid")).drop("reasons", "is_valid")
    return valid, checked.filter("NOT is_valid").drop("is_valid")


def dedup_events(events: DataFrame) -> DataFrame:
    """First row per event key in arrival order (``seq``).

    A grouped minimum rather than a ranked window: copies collapse map-side, so a key with
    very many copies costs no more than any other.
    """
    rest = [c for c in events.columns if c not in EVENT_KEY]
    # Without an arrival order the least of the other columns stands for the first row.
    first = F.min_by(F.struct(*rest), "seq") if "seq" in rest else F.min(F.struct(*rest))
    kept = events.groupBy(*EVENT_KEY).agg(first.alias("first")) if rest else events.distinct()
    return kept.select(*EVENT_KEY, *[F.col(f"first.{c}").alias(c) for c in rest])


def insert_new_events(batch: DataFrame, table: DataFrame) -> DataFrame:
    """Rows of ``batch`` to insert: first per key, and no such key in ``table`` yet."""
    return dedup_events(batch).join(table.select(*EVENT_KEY), EVENT_KEY, "left_anti")


def batch_visitors(events: DataFrame) -> DataFrame:
    return events.select("visitor_id").distinct()


def index_documents(events: DataFrame) -> DataFrame:
    """Search documents by ``doc_id``; of equal ids the last written stays.

    The id is made of the event key, so copies are combined on the key and the text columns
    are only built for the rows that remain.
    """
    latest = events.groupBy(*EVENT_KEY).agg(
        F.max_by("transaction_id", "seq").alias("transaction_id")
    )
    return latest.select(
        document_id().alias("doc_id"),
        iso_text(F.col("timestamp")).alias("event_time"),
        "timestamp",
        "visitor_id",
        "event",
        "item_id",
        "transaction_id",
    )
