"""Measurements of running streams, stored as they come, in the layouts the monitoring operators take.

A listener puts every progress report into a folder, so lifetime figures cover every
micro-batch; what Spark itself keeps of a query is only its last hundred.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pathwake.sinks.versions import Files

# Fixed names: fields of a progress report that are read. Offsets stay as their JSON text.
REPORT = (
    "id string, runId string, name string, timestamp string, batchId bigint, numInputRows bigint, "
    "durationMs map<string, bigint>, "
    "stateOperators array<struct<allUpdatesTimeMs: bigint, commitTimeMs: bigint, numShufflePartitions: bigint>>, "
    "sources array<struct<startOffset: string, endOffset: string, latestOffset: string>>, "
    "observedMetrics map<string, map<string, bigint>>"
)
# Phases of a micro-batch that count as polling and as committing.
POLLING = ["latestOffset", "getBatch", "queryPlanning"]
COMMITTING = ["walCommit", "commitOffsets"]
JOINED = 100  # reports that are put together in one file
PRODUCED = "produced"


class ProgressLog(StreamingQueryListener):
    """Stores each progress of each query under ``path``, one file a report, joined by hundreds.

    A report is written when Spark gives it, so what a lost driver has not stored is at most
    the report of the batch at hand. A batch that is run again replaces its report.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._path, self._files = path.rstrip("/"), Files(spark, path)
        self._ended: dict[str, threading.Event] = {}
        self._single: dict[str, list[str]] = {}

    def onQueryStarted(self, event) -> None:
        self._of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = event.progress
        folder = f"{self._path}/query={report.id}"
        name = f"{folder}/{report.batchId:012d}.json"
        self._files.write(name, report.json.replace("\n", " ") + "\n")
        single = self._single.setdefault(folder, [])
        single.append(name)
        if len(single) >= JOINED:
            # Written before the single files go: a crash in between leaves reports twice.
            self._files.write(f"{folder}/{report.batchId:012d}-{JOINED}.json", "".join(map(self._files.read, dict.fromkeys(single))))
            for old in dict.fromkeys(single):
                self._files.remove(old)
            single.clear()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._of(str(event.runId)).set()

    def _of(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait for the last report of a query that has ended; reports come a little later."""
        return self._of(str(query.runId)).wait(seconds)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One report per query and batch, the newest where a batch was run again."""
    rows = spark.read.schema(REPORT).json(path).filter("id is not null")
    rest = [f for f in rows.columns if f not in ("id", "batchId")]
    # Maps cannot be compared, so the time picks the report.
    latest = rows.groupBy("id", "batchId").agg(F.max_by(F.struct(*rest), "timestamp").alias("latest"))
    return latest.select("id", "batchId", "latest.*")


def _took(*phases: str) -> Column:
    return sum((F.coalesce(F.col("durationMs")[p], F.lit(0)) for p in phases), F.lit(0)).cast("double")


def _end_ms() -> Column:
    return F.unix_millis(F.col("timestamp").cast("timestamp")) + _took("triggerExecution").cast("bigint")


def batch_metrics(progress: DataFrame, max_batch_size: int = 0) -> DataFrame:
    """One row per micro-batch of :func:`read_progress`, as the batch operators take them.

    State work counts as the state stage. The sink counts as the session stage where the query
    has state, else as the event stage.
    """
    parts = F.transform(
        "stateOperators",
        lambda o: (o["allUpdatesTimeMs"] + o["commitTimeMs"]) / F.greatest(o["numShufflePartitions"], F.lit(1)),
    )  # state times are summed over parallel partitions
    state = F.coalesce(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))
    sink = F.greatest(F.lit(0.0), _took("addBatch") - state)
    stateful = F.coalesce(F.size("stateOperators") > 0, F.lit(False))
    return progress.select(
        F.coalesce("name", "id").alias("group_id"),
        F.lit(0).cast("bigint").alias("instance"),
        F.col("batchId").alias("batch_id"),
        _end_ms().alias("end_ms"),
        F.col("numInputRows").alias("batch_size"),
        F.lit(max_batch_size).cast("bigint").alias("max_batch_size"),
        F.when(stateful, 0.0).otherwise(sink).alias("pg_events_ms"),
        state.alias("valkey_ms"),
        F.when(stateful, sink).otherwise(0.0).alias("pg_sessions_ms"),
        _took(*POLLING).alias("poll_ms"),
        _took(*COMMITTING).alias("commit_ms"),
    )


def offsets(progress: DataFrame) -> DataFrame:
    """Position and end offset per query, topic and partition, from each query's newest report.

    Sources that count otherwise than by topic and partition give no rows; an end offset that
    is not reported is null.
    """
    newest = progress.groupBy("id").agg(F.max_by("sources", "batchId").alias("sources"))
    layout = "map<string, map<string, bigint>>"
    each = newest.select("id", F.explode("sources").alias("s")).select(
        "id", F.from_json("s.endOffset", layout).alias("reached"), F.from_json("s.latestOffset", layout).alias("newest")
    )
    topics = each.select("id", "newest", F.explode("reached").alias("topic", "parts"))
    parts = topics.select("id", "newest", "topic", F.explode("parts").alias("part", "committed")).filter("committed is not null")
    end = F.try_element_at(F.try_element_at("newest", F.col("topic")), F.col("part"))
    return parts.select("id", "topic", F.col("part").cast("bigint").alias("part"), "committed", end.alias("end_offset"))


def counted(messages: DataFrame) -> DataFrame:
    """The stream, with its messages counted in every progress report."""
    return messages.observe(PRODUCED, F.count(F.lit(1)).alias("messages"))


def produced(progress: DataFrame) -> DataFrame:
    """``(id, batch_id, messages)`` of the batches of :func:`counted` streams."""
    messages = F.col("observedMetrics")[PRODUCED]["messages"]
    return progress.filter(messages.isNotNull()).select("id", F.col("batchId").alias("batch_id"), messages.alias("messages"))
