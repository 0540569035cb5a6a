"""Keyed message streams: a broker, or a folder of message files with the same columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pathwake.runtime import configure
from pathwake.schemas import MESSAGE


def stream_source(
    spark: SparkSession,
    path: str | None = None,
    topic: str = "events",
    max_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Messages from the earliest on: key, value, topic, partition, offset, timestamp, headers.

    Without ``path`` the topic is read from the broker in ``options``. ``max_per_batch``
    bounds a micro-batch: messages of a topic, or files of a folder; None takes what is there. Where a query has
    stopped before, its checkpoint decides where it goes on.
    """
    configure(spark)
    if path is not None:
        reader = spark.readStream.schema(MESSAGE).options(**(options or {}))
        if max_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", max_per_batch)
        return reader.parquet(path)
    reader = (
        spark.readStream.format("kafka")
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("includeHeaders", True)
        .options(**(options or {}))
    )
    if max_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load().withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )


@contextmanager
def state_partitions(spark: SparkSession, number: int | None = None) -> Iterator[None]:
    """Number of state partitions of queries first started inside (default: twice the cores).

    A stream keeps the number it started with. Each partition costs a state store and a
    commit per micro-batch, so the setting for batch shuffles is often too high; it is never
    raised here.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    wanted = number or 2 * spark.sparkContext.defaultParallelism
    spark.conf.set(key, str(min(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_available(writer, checkpoint: str, wait: bool = True) -> StreamingQuery:
    """Process everything available now, then stop. Later calls go on from the checkpoint.

    Readers with different checkpoints are independent and each sees the whole stream. Without
    ``wait`` the query is returned while it runs.
    """
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    if wait:
        query.awaitTermination()
    return query


def run_continuously(writer, checkpoint: str, interval: str = "1 second") -> StreamingQuery:
    """Start a query that takes a micro-batch per interval; a slow sink delays the next."""
    return (
        writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()
    )
