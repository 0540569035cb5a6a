"""Stored tables: events, sessions, search documents and result files.

Every streaming write is keyed by its stream and batch id and replaces what an earlier attempt
at the same batch of the same stream wrote, so a replayed batch changes nothing, and a stream
on a new checkpoint, or a second stream into the same table, never overwrites rows of another.
Events, sessions and documents are :class:`VersionedTable`: batches are folded into runs as the
stream goes. Which version of a row is the later one follows from the rows, not from a clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pathwake.functions.columns import event_time
from pathwake.operators.events import index_documents, insert_new_events
from pathwake.operators.traffic import item_metrics, visitor_metrics
from pathwake.schemas import (
    EVENT,
    EVENT_TABLE,
    ITEM_METRICS,
    SESSION_TABLE,
    STORED_DOCUMENT,
    STORED_EVENT,
    STORED_SESSION,
    VISITOR_METRICS,
)
from pathwake.sinks.versions import Files, VersionedTable

TABLES = {
    "events": EVENT_TABLE,
    "sessions": SESSION_TABLE,
    "item_metrics": ITEM_METRICS,
    "visitor_metrics": VISITOR_METRICS,
}
_KEPT = ["visitor_id", "session_start"]  # an upsert never changes these
_REPLACED = [f.name for f in SESSION_TABLE if f.name not in ("session_id", *_KEPT)]
_DOCUMENT = ["doc_id", "event_time", "timestamp", "visitor_id", "event", "item_id"]
DEFAULT_STREAM = "main"
MANY_DATES = 64  # of a batch; beyond, one range of times stands for all of them


def merge_sessions(versions: DataFrame, version: str = "version") -> DataFrame:
    """One row per session from successive versions of it.

    Visitor and start come from the oldest version, everything else from the newest; lists
    are replaced, not joined. Copies of a session collapse map-side.
    """
    latest = F.max_by(F.struct(*_REPLACED), version).alias("latest")
    kept = [F.min_by(c, version).alias(c) for c in _KEPT]
    merged = versions.groupBy("session_id").agg(*kept, latest)
    return merged.select("session_id", *_KEPT, "latest.*").select(*SESSION_TABLE.names)


def upsert_sessions(table: DataFrame, updates: DataFrame) -> DataFrame:
    """The session table after ``updates`` (both in the table layout)."""
    old = table.select(*SESSION_TABLE.names, F.lit(0).alias("version"))
    new = updates.select(*SESSION_TABLE.names, F.lit(1).alias("version"))
    return merge_sessions(old.unionByName(new))


def event_table(spark: SparkSession, path: str) -> VersionedTable:
    """Stored events in folders by date; keys are unique, so there is nothing to merge."""
    return VersionedTable(spark, path, STORED_EVENT, lambda rows: rows, "event_date")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return event_table(spark, path).read()


def stored_keys(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of ``stored`` that can have a key of ``batch``.

    A key includes the time, so only the dates of the batch are read, and of a date only row
    groups between the least and the greatest time the batch has there. A batch has no more
    dates than the calendar, so their list is small.
    """
    date = F.to_date(event_time(F.col("timestamp")))
    spans = batch.groupBy(date.alias("event_date")).agg(F.min("timestamp"), F.max("timestamp")).collect()
    if not spans:
        return stored.limit(0)
    inside = F.col("event_date").isin([s[0] for s in spans])
    if len(spans) > MANY_DATES:
        return stored.filter(inside & F.col("timestamp").between(min(s[1] for s in spans), max(s[2] for s in spans)))
    between = F.lit(False)
    for day, low, high in spans:
        between |= (F.col("event_date") == day) & F.col("timestamp").between(low, high)
    return stored.filter(inside & between & F.col("timestamp").between(min(s[1] for s in spans), max(s[2] for s in spans)))


def insert_events(
    batch: DataFrame, batch_id: int, path: str, stream_id: str = DEFAULT_STREAM
) -> None:
    """Append the batch's events whose key is not stored yet.

    New rows are compared with all but those this batch of this stream wrote before.
    """
    spark = batch.sparkSession
    if "seq" not in batch.columns:
        batch = batch.withColumn("seq", F.lit(0).cast("bigint"))
    table = event_table(spark, path)
    batch = batch.select(*EVENT.names, "seq").persist()
    try:
        stored = stored_keys(batch, table.rows(without=(stream_id, batch_id)))
        fresh = insert_new_events(batch, stored)
        table.add(fresh.withColumn("event_date", F.to_date(event_time(F.col("timestamp")))), stream_id, batch_id)
    finally:
        batch.unpersist()


def compact_events(spark: SparkSession, path: str, target: str) -> None:
    """Write the event table to ``target`` as one run, to be added to from then on.

    A batch replayed into ``target`` finds its rows there and adds nothing.
    """
    event_table(spark, path).copy_to(target)


def session_table(spark: SparkSession, path: str) -> VersionedTable:
    """Stored versions of sessions; one row a session and run."""
    return VersionedTable(spark, path, STORED_SESSION, _merge_versions)


def _merge_versions(rows: DataFrame) -> DataFrame:
    """One row per session: the start of its first version, the rest of its last.

    Both are kept with the row, so that any grouping of versions gives the same. A session of
    one stream grows with every batch that changes it: its end never falls and its count of
    events rises, so they give the order of its versions, and that of different streams by
    event time.
    """
    latest = F.max_by(F.struct(*_REPLACED), "version").alias("latest")
    kept = [F.min_by(c, "born").alias(c) for c in _KEPT]
    merged = rows.groupBy("session_id").agg(
        *kept, latest, F.min("born").alias("born"), F.max("version").alias("version")
    )
    return merged.select("session_id", *_KEPT, "latest.*", "born", "version").select(*STORED_SESSION.names)


def log_sessions(
    sessions: DataFrame, batch_id: int, path: str, stream_id: str = DEFAULT_STREAM
) -> None:
    """Add a batch of changed sessions (table layout); cost depends on the batch alone."""
    moment = F.struct("session_end", "event_count", F.lit(stream_id).alias("stream_id"))
    rows = sessions.select(*SESSION_TABLE.names, moment.alias("born"), moment.alias("version"))
    session_table(sessions.sparkSession, path).add(rows, stream_id, batch_id)


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The session table: all stored versions merged."""
    return session_table(spark, path).read().select(*SESSION_TABLE.names)


def compact_sessions(spark: SparkSession, path: str, target: str) -> None:
    """Write the merged sessions to ``target`` as one run, to be logged to from then on."""
    session_table(spark, path).copy_to(target)


def document_table(spark: SparkSession, path: str) -> VersionedTable:
    """Stored versions of search documents; one row a document and run."""
    return VersionedTable(spark, path, STORED_DOCUMENT, _latest_documents)


def _latest_documents(rows: DataFrame) -> DataFrame:
    """The last version per id: later batches of a stream, of two streams the later name."""
    latest = [F.max_by("transaction_id", "version").alias("transaction_id"), F.max("version").alias("version")]
    return rows.groupBy(*_DOCUMENT).agg(*latest)


def index_batch(
    batch: DataFrame, batch_id: int, path: str, stream_id: str = DEFAULT_STREAM
) -> None:
    """Add a batch of search documents."""
    version = F.struct(F.lit(stream_id).alias("stream_id"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    rows = index_documents(batch).withColumn("version", version)
    document_table(batch.sparkSession, path).add(rows, stream_id, batch_id)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Search documents, the last written per id."""
    return document_table(spark, path).read().drop("version")


def compact_documents(spark: SparkSession, path: str, target: str) -> None:
    """Write the last version of each document to ``target`` as one run, to be added to from then on."""
    document_table(spark, path).copy_to(target)


def export_documents(spark: SparkSession, path: str, target: str) -> None:
    """Write the documents as JSON lines with explicit nulls, for a search server to load."""
    read_documents(spark, path).write.mode("overwrite").option("ignoreNullFields", False).json(target)


def _batch_path(path: str, stream_id: str, batch_id: int) -> str:
    return f"{path}/stream_id={stream_id}/batch_id={batch_id}"


def quarantine_batch(
    rejected: DataFrame, batch_id: int, path: str, stream_id: str = DEFAULT_STREAM
) -> None:
    """Set rows aside that no table takes, with their reasons."""
    rejected.write.mode("overwrite").parquet(_batch_path(path, stream_id, batch_id))


def publish(
    messages: DataFrame, options: dict[str, str] | None = None, path: str | None = None
) -> int:
    """Write message rows to a broker (``options``) or to a folder (``path``).

    Returns the number of messages, counted while they are written.
    """
    counter = Observation("published")
    counted = messages.observe(counter, F.count(F.lit(1)).alias("messages"))
    if path is not None:
        counted.write.mode("append").parquet(path)
    else:
        counted.select("key", "value", "topic").write.format("kafka").options(**options).save()
    return counter.get["messages"]


def append_results(path: str, first: DataFrame, *more: DataFrame) -> None:
    """Append result rows as CSV with a header.

    Inputs may lack each other's columns. A file that exists keeps its columns: missing ones
    are left empty, and a column it does not have is refused.
    """
    rows = first
    for other in more:
        rows = rows.unionByName(other, allowMissingColumns=True)
    spark = rows.sparkSession
    if Files(spark, path).exists(path):
        columns = spark.read.option("header", True).csv(path).columns
        extra = sorted(set(rows.columns) - set(columns))
        if extra:
            raise ValueError(f"columns not in the result file: {', '.join(extra)}")
        rows = rows.select(
            [rows[c] if c in rows.columns else F.lit(None).cast("string").alias(c)
             for c in columns]
        )
    rows.write.mode("append").option("header", True).csv(path)


PARTITIONED = {"events": "event_date"}  # of the tables below; others are replaced as a whole


def create_tables(spark: SparkSession, database: str) -> None:
    """Create the tables of the data model where they do not exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, layout in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in layout)
        parted = ""
        if name in PARTITIONED:
            columns += f", {PARTITIONED[name]} date"
            parted = f" PARTITIONED BY ({PARTITIONED[name]})"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{parted}")


def fill_tables(
    spark: SparkSession, database: str, folder: str, since: str | None = None
) -> None:
    """Bring the catalog's tables up to date with what streams have stored under ``folder``.

    Events replace the dates they have, from ``since`` (a date) on if given; the other dates of
    the table stay. Sessions and the metrics of items and visitors are replaced; these are
    computed from the stored events and sessions.
    """
    events = read_events(spark, f"{folder}/events")
    sessions = read_sessions(spark, f"{folder}/sessions")
    rows = events if since is None else events.filter(F.col("event_date") >= F.lit(since).cast("date"))
    timed = rows.withColumn("event_time", event_time(F.col("timestamp")))
    # Only the dates that come with the rows are replaced; tables of the catalog go by the setting.
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        days = timed.select(*EVENT_TABLE.names, "event_date").hint("rebalance", "event_date")
        days.write.insertInto(f"{database}.events", overwrite=True)
    finally:
        spark.conf.set(mode, before)
    replaced = {
        "sessions": sessions,
        "item_metrics": item_metrics(events),
        "visitor_metrics": visitor_metrics(events, sessions),
    }
    for name, made in replaced.items():
        made.select(*TABLES[name].names).write.insertInto(f"{database}.{name}", overwrite=True)


def reset_tables(spark: SparkSession, database: str, *folders: str) -> None:
    """Drop the tables with their rows and create them empty.

    ``folders``, those of the stored tables and of the checkpoints, are removed too: a stream
    started afterwards begins anew and finds nothing stored. No stream may run meanwhile.
    """
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    for folder in folders:
        Files(spark, folder).remove(folder)
    create_tables(spark, database)
