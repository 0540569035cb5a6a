"""The stored tables fed from one message stream, each with its own progress."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwake.operators.events import split_valid_rejected
from pathwake.operators.messages import decode_messages, readable
from pathwake.operators.sessions import to_table
from pathwake.schemas import SESSION_TIMEOUT_MS
from pathwake.sinks.tables import (
    DEFAULT_STREAM,
    index_batch,
    insert_events,
    log_sessions,
    quarantine_batch,
)
from pathwake.streaming.source import run_available
from pathwake.streaming.supervision import supervise
from pathwake.streaming.dedup import split_late, stream_dedup
from pathwake.streaming.sessions import stream_sessions

BatchSink = Callable[..., None]


def decoded_events(messages: DataFrame) -> DataFrame:
    """Valid events of a message stream; ``seq`` is the offset within the partition."""
    ordered = messages.withColumnRenamed("offset", "seq")
    valid, _ = split_valid_rejected(readable(decode_messages(ordered)))
    return valid


def session_events(messages: DataFrame) -> DataFrame:
    """Readable events of any type; only the visitor and the time are needed for sessions."""
    rows = readable(decode_messages(messages.withColumnRenamed("offset", "seq")))
    return rows.filter("visitor_id is not null and timestamp is not null")


def rejected_messages(messages: DataFrame) -> DataFrame:
    """Messages the event table does not take: key, value, partition, offset and reasons."""
    decoded = decode_messages(messages.withColumn("seq", F.col("offset")).withColumn("raw", F.col("value")))
    place = [c for c in ("key", "partition", "offset") if c in decoded.columns]
    corrupt = decoded.filter("corrupt is not null").select(
        *place, "raw", F.array(F.lit("unreadable")).alias("reasons")
    )
    _, rejected = split_valid_rejected(readable(decoded))
    return corrupt.unionByName(rejected.select(*place, "raw", F.col("reasons").cast("array<string>").alias("reasons")))


def to_sink(stream: DataFrame, sink: BatchSink):
    """Writer that hands every micro-batch to ``sink(batch, batch_id)``."""
    return stream.writeStream.outputMode("update").foreachBatch(sink)


# A stream's id keeps its rows apart from those of other streams into the same table. It has
# to stay the same as long as the checkpoint does, and be another for another checkpoint.
def events_writer(messages: DataFrame, path: str, stream_id: str = DEFAULT_STREAM):
    """Insert new events (first per key)."""
    return to_sink(decoded_events(messages), lambda b, i: insert_events(b, i, path, stream_id))


def sessions_writer(
    messages: DataFrame,
    path: str,
    timeout_ms: int = SESSION_TIMEOUT_MS,
    ttl_ms: int | None = None,
    stream_id: str = DEFAULT_STREAM,
    late_after: str = "1 day",
):
    """Log changed sessions; duplicates and unknown types count, as they do in batch.

    With ``ttl_ms`` the state of visitors that have been quiet so long is cleared, ``late_after``
    behind the newest event. Late events are kept at any age; after that they open a session.
    """
    sessions = stream_sessions(session_events(messages), timeout_ms, ttl_ms, late_after)
    return to_sink(sessions, lambda b, i: log_sessions(to_table(b), i, path, stream_id))


def documents_writer(messages: DataFrame, path: str, stream_id: str = DEFAULT_STREAM):
    """Index events as documents, the last per id."""
    return to_sink(decoded_events(messages), lambda b, i: index_batch(b, i, path, stream_id))


def first_rows_writer(
    messages: DataFrame, path: str, late_path: str, late_after: str = "1 day"
):
    """First rows per key to ``path``, rows that come too late to judge to ``late_path``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for rows, target in zip(split_late(batch), (path, late_path), strict=True):
                rows.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    first = stream_dedup(decoded_events(messages), late_after)
    return first.writeStream.outputMode("append").foreachBatch(store)


def quarantine_writer(messages: DataFrame, path: str, stream_id: str = DEFAULT_STREAM):
    """Set aside what the event table does not take, with reasons."""
    return to_sink(
        rejected_messages(messages), lambda b, i: quarantine_batch(b, i, path, stream_id)
    )


def session_pipeline(
    messages: DataFrame,
    folder: str,
    checkpoints: str,
    timeout_ms: int = SESSION_TIMEOUT_MS,
    ttl_ms: int | None = None,
    stream_id: str = DEFAULT_STREAM,
    run: Callable = run_available,
    late_after: str = "1 day",
) -> list:
    """Events, sessions, documents and quarantine from one topic, each with its own progress.

    Tables lie in subfolders of ``folder`` with these names, progress in those of
    ``checkpoints``. Returns what ``run`` gave for each.
    """
    writers = pipeline_writers(messages, folder, timeout_ms, ttl_ms, stream_id, late_after)
    return [run(writer, f"{checkpoints}/{name}") for name, writer in writers.items()]


def pipeline_writers(
    messages: DataFrame,
    folder: str,
    timeout_ms: int = SESSION_TIMEOUT_MS,
    ttl_ms: int | None = None,
    stream_id: str = DEFAULT_STREAM,
    late_after: str = "1 day",
) -> dict:
    """The writers of :func:`session_pipeline` by table."""
    return {
        "events": events_writer(messages, f"{folder}/events", stream_id),
        "sessions": sessions_writer(
            messages, f"{folder}/sessions", timeout_ms, ttl_ms, stream_id, late_after
        ),
        "documents": documents_writer(messages, f"{folder}/documents", stream_id),
        "quarantine": quarantine_writer(messages, f"{folder}/quarantine", stream_id),
    }


def supervised_pipeline(messages: DataFrame, folder: str, checkpoints: str, attempts: int = 5, delay_sec: float = 1.0, **options) -> dict[str, int]:
    """:func:`session_pipeline` with all four streams at once; one that fails is started again.

    Each takes what is available and stops. Returns how often each was started again.
    """
    writers = pipeline_writers(messages, folder, **options)
    starts = {
        name: partial(run_available, writer, f"{checkpoints}/{name}", wait=False)
        for name, writer in writers.items()
    }
    return supervise(starts, attempts, delay_sec)
