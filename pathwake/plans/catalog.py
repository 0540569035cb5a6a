"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathwake.functions.columns import json_rows
from pathwake.operators import batches, benchmarks, events, lag, messages, replay, sessions, traffic
from pathwake.plans.overview import status_overview
from pathwake.runtime import new_path, stored
from pathwake.schemas import EVENT_KEY, STATE_TTL_MS
from pathwake.sinks import tables as sinks
from pathwake.sources import adapters as views
from pathwake.sources import files
from pathwake.streaming import source as streams
from pathwake.sources.partitioned import stream_events_csv
from pathwake.streaming import progress
from pathwake.streaming import tables as stream_tables
from pathwake.streaming.sessions import state_changes, stored_state, stream_closed_sessions
from pathwake.streaming.supervision import supervise

Query = Callable[[SparkSession, str], DataFrame]

HOUR, DAY = 3600, 86_400
HALF_DAY_MS, DAY_MS = 43_200_000, 86_400_000
MIDDLE_MS = 1_705_363_200_000  # 2024-01-16, splits the event log into two parts
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def flat(df: DataFrame) -> DataFrame:
    """Result columns as plain values: UTC times without zone, lists and maps as text."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.MapType):
            pairs = F.transform(
                F.map_entries(column), lambda e: F.concat_ws(":", e["key"], e["value"])
            )
            column = F.array_join(pairs, ",")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        return column.alias(field.name)

    return df.select([plain(f) for f in df.schema])


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Floating sums depend on the order of addition; fix the digits that are compared.

    Adding zero turns a negative zero into a plain one.
    """
    return df.withColumns({c: F.round(c, n) + F.lit(0.0) for c, n in digits.items()})


# ---------------------------------------------------------------- events and messages

query("normalize_events")(
    lambda spark, d: flat(events.normalize_events(views.raw_csv(spark, d)))
)


@query("scan_events_csv")
def _scan_events_csv(spark, d):
    path = new_path(spark, "events-csv")
    views.raw_csv(spark, d).drop("seq").write.option("header", True).csv(path)
    return flat(events.normalize_events(files.scan_events_csv(spark, path)))


@query("validate_events")
def _validate(spark, d):
    checked = events.validate_events(views.raw_text(spark, d))
    return flat(checked.select("seq", "event", "reasons", "is_valid"))


@query("split_valid_rejected")
def _split(spark, d):
    valid, rejected = events.split_valid_rejected(views.raw_text(spark, d))
    rejected = rejected.select("seq", "event", F.array_join("reasons", ",").alias("reasons"))
    return valid.unionByName(rejected, allowMissingColumns=True)


query("dedup_events")(
    lambda spark, d: events.dedup_events(views.clicks_with_copies(spark, d))
)


@query("insert_new_events")
def _insert(spark, d):
    table = views.clicks(spark, d).filter("seq % 3 = 0")
    return events.insert_new_events(views.clicks_with_copies(spark, d), table)


query("slice_events")(lambda spark, d: replay.slice_events(views.clicks(spark, d), 100))
query("slice_events_page")(
    lambda spark, d: replay.slice_events(views.clicks(spark, d), 100, 500)
)
query("batch_visitors")(lambda spark, d: events.batch_visitors(views.clicks(spark, d)))
query("publish_events")(
    lambda spark, d: messages.publish_events(views.clicks(spark, d)).drop("partition")
)
query("decode_messages")(
    lambda spark, d: messages.decode_messages(views.messages(spark, d)).drop("value")
)
query("decode_messages_with_errors")(
    lambda spark, d: messages.decode_messages(
        views.messages(spark, d).withColumn("error", F.expr("if(seq % 10 = 0, 'timed out', null)"))
    ).drop("value")
)
query("unwrap_messages")(lambda spark, d: messages.unwrap_messages(views.messages(spark, d)))
query("index_documents")(
    lambda spark, d: events.index_documents(views.clicks_with_copies(spark, d))
)


# ---------------------------------------------------------------- sessions

def _table(df: DataFrame) -> DataFrame:
    return flat(sessions.to_table(df))


query("sessionize")(lambda spark, d: _table(sessions.sessionize(views.clicks(spark, d))))
query("sessionize_12h")(
    lambda spark, d: _table(sessions.sessionize(views.clicks(spark, d), HALF_DAY_MS))
)
query("sessionize_heavy")(
    # every visitor takes the path of very large visitors
    lambda spark, d: _table(
        sessions.sessionize(views.clicks(spark, d), HALF_DAY_MS, heavy_rows=1)
    )
)
query("sessionize_all_types")(
    lambda spark, d: _table(sessions.sessionize(views.all_events(spark, d), HALF_DAY_MS))
)
query("sessionize_copies")(
    lambda spark, d: _table(sessions.sessionize(views.clicks_with_copies(spark, d), HALF_DAY_MS))
)
query("sessionize_dedupe")(
    lambda spark, d: _table(
        sessions.sessionize(views.clicks_with_copies(spark, d), HALF_DAY_MS, dedupe=True)
    )
)
query("session_item_sets")(
    lambda spark, d: flat(
        sessions.session_item_sets(sessions.sessionize(views.clicks(spark, d), HALF_DAY_MS))
    )
)


@query("resume_sessions")
def _resume(spark, d):
    clicks = views.clicks(spark, d)
    early = sessions.sessionize(clicks.filter(F.col("timestamp") < MIDDLE_MS), HALF_DAY_MS)
    state = stored(sessions.state_to_text(sessions.latest_state(early)), "state")
    later = clicks.filter(F.col("timestamp") >= MIDDLE_MS)
    return _table(
        sessions.resume_sessions(later, sessions.state_from_text(state), HALF_DAY_MS)
    )


@query("upsert_sessions")
def _upsert(spark, d):
    clicks = views.clicks(spark, d)
    early = clicks.filter(F.col("timestamp") < MIDDLE_MS)
    table = sessions.to_table(sessions.sessionize(early))
    updates = sessions.to_table(sessions.sessionize(clicks, HALF_DAY_MS))
    return flat(sinks.upsert_sessions(table, updates))


def _newest(clicks: DataFrame):
    return clicks.select(F.max("timestamp").alias("newest")).scalar()


@query("active_sessions")
def _active(spark, d):
    clicks = views.clicks(spark, d)
    state = sessions.latest_state(sessions.sessionize(clicks))
    return sessions.active_sessions(state, _newest(clicks), STATE_TTL_MS)


# ---------------------------------------------------------------- funnel and traffic

def _stored_sessions(spark, d, timeout_ms=None):
    """Sessions written once; the funnel reads them twice."""
    clicks = views.clicks(spark, d)
    made = sessions.sessionize(clicks, timeout_ms) if timeout_ms else sessions.sessionize(clicks)
    narrow = made.select("session_start", "cart_count", "transaction_count")
    return stored(narrow, "sessions")


query("funnel_metrics")(lambda spark, d: traffic.funnel_metrics(_stored_sessions(spark, d)))
query("funnel_metrics_12h")(
    lambda spark, d: traffic.funnel_metrics(_stored_sessions(spark, d, HALF_DAY_MS))
)
query("funnel_json")(lambda spark, d: traffic.funnel_json(_stored_sessions(spark, d)))
query("conversion_funnel")(
    lambda spark, d: flat(traffic.conversion_funnel(views.clicks(spark, d)))
)
query("hourly_traffic")(lambda spark, d: traffic.hourly_traffic(views.clicks(spark, d)))
query("item_metrics")(lambda spark, d: flat(traffic.item_metrics(views.clicks(spark, d))))


@query("visitor_metrics")
def _visitors(spark, d):
    clicks = views.clicks(spark, d)
    return flat(traffic.visitor_metrics(clicks, sessions.sessionize(clicks)))


query("event_type_breakdown")(
    lambda spark, d: traffic.event_type_breakdown(views.all_events(spark, d))
)
query("event_type_bars")(
    lambda spark, d: traffic.event_type_breakdown(views.all_events(spark, d), 3)
)
query("events_over_time")(
    lambda spark, d: flat(traffic.events_over_time(views.clicks(spark, d)))
)
query("events_over_time_auto")(
    lambda spark, d: flat(
        traffic.events_over_time(views.clicks(spark, d), None, "2024-01-05", "2024-01-12")
    )
)
query("events_over_time_range")(
    lambda spark, d: flat(
        traffic.events_over_time(
            views.clicks(spark, d), "1 day", "2024-01-05 00:00:00", "2024-01-25 00:00:00"
        )
    )
)
query("top_viewed_items")(lambda spark, d: traffic.top_viewed_items(views.clicks(spark, d)))
query("top_purchased_items")(
    lambda spark, d: traffic.top_purchased_items(views.clicks(spark, d))
)


@query("table_counts")
def _counts(spark, d):
    clicks = views.clicks(spark, d)
    return traffic.table_counts(events=clicks, sessions=sessions.sessionize(clicks))


# ---------------------------------------------------------------- offsets and lag

def _offsets(spark, d):
    return views.committed_offsets(spark, d), views.end_offsets(spark, d)


query("consumer_lag")(lambda spark, d: lag.consumer_lag(*_offsets(spark, d)))
query("live_lag")(lambda spark, d: lag.live_lag(*_offsets(spark, d)))
query("live_lag_total")(
    lambda spark, d: lag.total_live_lag(lag.live_lag(*_offsets(spark, d)))
)
query("partitions_at_end")(lambda spark, d: lag.partitions_at_end(*_offsets(spark, d)))
query("partitions_at_end_revoked")(
    lambda spark, d: lag.partitions_at_end(
        *_offsets(spark, d), revoked=views.committed_offsets(spark, d).filter("part = 3")
    )
)
query("topic_message_counts_internal")(
    lambda spark, d: lag.topic_message_counts(
        views.end_offsets(spark, d).withColumn(
            "topic", F.expr("if(part = 1, '__' || topic, if(part = 2, topic || '__assignor', topic))")
        )
    )
)
query("topic_message_counts")(
    lambda spark, d: lag.topic_message_counts(views.end_offsets(spark, d))
)
query("lag_history")(
    lambda spark, d: flat(lag.lag_history(views.lag_samples(spark, d), None))
)
query("lag_json")(lambda spark, d: json_rows(lag.consumer_lag(*_offsets(spark, d))))
query("lag_history_json")(
    lambda spark, d: json_rows(lag.lag_history(views.lag_samples(spark, d), None))
)
query("lag_history_window")(
    lambda spark, d: flat(lag.lag_history(views.lag_samples(spark, d), DAY))
)
query("lag_history_pivot")(
    lambda spark, d: lag.lag_history_pivot(views.lag_samples(spark, d), None, None)
)
query("seen_partitions")(lambda spark, d: lag.seen_partitions(views.lag_samples(spark, d)))
query("lag_trend")(lambda spark, d: lag.lag_trend(views.lag_samples(spark, d), None))
query("lag_trend_window")(
    lambda spark, d: lag.lag_trend(views.lag_samples(spark, d), 2 * HOUR)
)
query("lag_trend_rolling")(
    lambda spark, d: lag.lag_trend_rolling(views.lag_samples(spark, d))
)
query("sample_retention")(
    lambda spark, d: lag.sample_retention(views.lag_samples(spark, d), 7 * DAY)
)
query("current_rate")(
    lambda spark, d: rounded(
        lag.current_rate(views.counter_samples(spark, d), DAY), {"current_rate": 9}
    )
)
query("rebalance_stability")(
    lambda spark, d: lag.rebalance_stability(views.rebalances(spark, d), HOUR)
)


# ---------------------------------------------------------------- batch timings

INDICATORS = {"fill_ratio": 9, "poll_proximity": 9, "idle_ms": 4}
POLL_LIMIT_MS = 1000


def _indicators(spark, d):
    return batches.batch_indicators(
        views.batch_metrics(spark, d), views.rebalances(spark, d), DAY_MS, POLL_LIMIT_MS
    )


@query("batch_indicators")
def _batch_indicators(spark, d):
    return rounded(_indicators(spark, d), INDICATORS).drop("period")


query("backpressure_report")(
    lambda spark, d: rounded(
        lag.with_labels(lag.backpressure_report(_indicators(spark, d))), INDICATORS
    )
)


@query("lag_report")
def _lag_report(spark, d):
    indicators = _indicators(spark, d)
    report = lag.lag_report(views.lag_samples(spark, d), indicators, DAY, 7 * DAY)
    return rounded(report, INDICATORS)


query("poll_proximity")(
    lambda spark, d: rounded(
        batches.poll_proximity(views.batch_metrics(spark, d), POLL_LIMIT_MS), {"proximity": 9}
    )
)
query("idle_gap")(
    lambda spark, d: rounded(batches.idle_gap(views.batch_metrics(spark, d)), {"idle_ms": 4})
)
query("stage_trend_rolling")(
    lambda spark, d: rounded(
        batches.stage_trend_rolling(views.batch_metrics(spark, d)),
        {f"{stage}_slope": 7 for stage in batches.STAGES},
    )
)
query("stage_trends")(
    lambda spark, d: rounded(batches.stage_trends(views.batch_metrics(spark, d)), {"slope": 6})
)
query("stage_trends_sensitive")(
    lambda spark, d: rounded(
        batches.stage_trends(views.batch_metrics(spark, d), 0.02), {"slope": 6}
    )
)
query("bottleneck_stage")(
    lambda spark, d: batches.bottleneck_stage(views.batch_metrics(spark, d))
)
query("bottleneck_stage_sensitive")(
    lambda spark, d: batches.bottleneck_stage(views.batch_metrics(spark, d), 0.02)
)

SUMMARY = {
    **{f"avg_{stage}_ms": 9 for stage in ("batch", *batches.STAGES, "poll", "commit")},
    "avg_idle_ms": 4, "avg_fill": 9, "headroom": 6, "events_per_sec": 9,
}
query("batch_summary")(
    lambda spark, d: rounded(batches.batch_summary(views.batch_metrics(spark, d), DAY_MS), SUMMARY)
)


@query("batch_report")
def _batch_report(spark, d):
    written = views.batch_metrics(spark, d).withColumn("sessions", F.expr("batch_size div 2"))
    report = batches.batch_report(written, views.rebalances(spark, d), POLL_LIMIT_MS, 0.02)
    return rounded(report, SUMMARY | {"max_poll_proximity": 9})


query("batch_lifetime")(
    lambda spark, d: rounded(batches.batch_summary(views.batch_metrics(spark, d), None), SUMMARY)
)


# ---------------------------------------------------------------- benchmark results

query("bench_filter")(
    lambda spark, d: flat(
        benchmarks.bench_filter(
            views.bench_runs(spark, d), "local", 1_704_412_800_000, 1_706_140_800_000
        )
    )
)
query("bench_summary")(lambda spark, d: benchmarks.bench_summary(views.bench_runs(spark, d)))
query("bench_throughput")(
    lambda spark, d: benchmarks.bench_throughput(views.bench_runs(spark, d))
)
query("ramp_steps")(lambda spark, d: benchmarks.ramp_steps(views.ramp_samples(spark, d)))
query("ramp_saturation")(
    lambda spark, d: benchmarks.ramp_saturation(views.ramp_samples(spark, d))
)
query("ramp_runs")(lambda spark, d: benchmarks.ramp_runs(views.ramp_samples(spark, d)))
query("ramp_latest_run")(
    lambda spark, d: benchmarks.ramp_latest_run(views.ramp_samples(spark, d))
)
query("sample_throughput")(
    lambda spark, d: benchmarks.sample_throughput(views.count_samples(spark, d))
)
query("stall_detection")(
    lambda spark, d: benchmarks.stall_detection(views.count_samples(spark, d), 10_000)
)


@query("replay_schedule")
def _replay(spark, d):
    schedule = replay.replay_schedule(views.clicks(spark, d), 10)
    return rounded(schedule.select("seq", "release_sec"), {"release_sec": 9})


@query("rate_limited_schedule")
def _rate_limited(spark, d):
    schedule = replay.rate_limited_schedule(views.clicks(spark, d), 500)
    return rounded(schedule.select("seq", "position", "release_sec"), {"release_sec": 9})


@query("status_overview")
def _status(spark, d):
    clicks = views.clicks(spark, d)
    made = stored(sessions.sessionize(clicks), "sessions")
    overview = status_overview(
        {"events": clicks, "sessions": made}, views.end_offsets(spark, d),
        sessions.latest_state(made), _newest(clicks), views.counter_samples(spark, d), DAY,
    )
    return rounded(overview, {"value": 9})


# ---------------------------------------------------------------- streams
# Each query publishes the events in time order in several portions and runs the stream after
# each, so the later runs go on from the checkpoint of the earlier ones.

SPLIT = "2024-01-16 12:00:00"  # everything before, then the rest


def _published(source: DataFrame) -> DataFrame:
    """Message rows of events, with the time of the event."""
    published = messages.publish_events(source.withColumn("ts", F.timestamp_millis("timestamp")))
    return published.withColumn(
        "timestamp", F.timestamp_millis(F.get_json_object("value", "$.timestamp").cast("bigint"))
    ).withColumnRenamed("seq", "offset")


def _in_portions(
    spark, source: DataFrame, start: Callable[[DataFrame, str], object], late: bool = False
) -> str:
    """Run ``start(messages, folder)`` over the portions; returns the folder written to.

    With ``late`` the earlier portion comes second.
    """
    base = new_path(spark, "stream")
    timed = _published(source)
    before = F.coalesce(F.col("timestamp") < SPLIT, F.lit(False))
    portions = (timed.filter(before), timed.filter(~before))
    for portion in reversed(portions) if late else portions:
        sinks.publish(portion, path=f"{base}/messages")
        writer = start(streams.stream_source(spark, f"{base}/messages"), f"{base}/out")
        with streams.state_partitions(spark):
            streams.run_available(writer, f"{base}/checkpoint")
    return f"{base}/out"


def _to_parquet(frame: DataFrame, path: str):
    return frame.writeStream.outputMode("append").format("parquet").option("path", path)


@query("stream_source")
def _stream_source(spark, d):
    out = _in_portions(
        spark, views.clicks(spark, d),
        lambda m, path: _to_parquet(stream_tables.decoded_events(m), path),
    )
    columns = ["key", "timestamp", "visitor_id", "event", "item_id", "transaction_id"]
    return spark.read.parquet(out).select(*columns)


@query("run_available")
def _run_available(spark, d):
    out = _in_portions(
        spark, views.clicks(spark, d),
        lambda m, path: _to_parquet(stream_tables.decoded_events(m), path),
    )
    return spark.read.parquet(out).groupBy("event").agg(
        F.count("*").alias("events"), F.sum("item_id").alias("item_sum")
    )


@query("stream_dedup")
def _stream_dedup(spark, d):
    out = _in_portions(
        spark, views.clicks_with_copies(spark, d),
        lambda m, path: stream_tables.first_rows_writer(m, f"{path}/first", f"{path}/late"),
    )
    first = spark.read.parquet(f"{out}/first")
    return first.select("timestamp", "visitor_id", "event", "item_id", "transaction_id")


@query("stream_dedup_late")
def _stream_dedup_late(spark, d):
    """The earlier portion comes second; what is more than sixteen days old then is set apart."""
    out = _in_portions(
        spark, views.clicks_with_copies(spark, d),
        lambda m, path: stream_tables.first_rows_writer(m, f"{path}/first", f"{path}/late", "16 days"),
        late=True,
    )
    parts = [
        spark.read.parquet(f"{out}/{part}").withColumn("part", F.lit(part)) for part in ("first", "late")
    ]
    return parts[0].unionByName(parts[1]).groupBy("part", "event").agg(
        F.count("*").alias("events"), F.sum("timestamp").alias("time_sum"), F.sum("seq").alias("seq_sum")
    )


@query("stream_events_table")
def _stream_events_table(spark, d):
    out = _in_portions(spark, views.clicks_with_copies(spark, d), stream_tables.events_writer)
    return sinks.read_events(spark, out).select(*EVENT_KEY, "transaction_id")


@query("stream_sessions")
def _stream_sessions(spark, d):
    out = _in_portions(
        spark, views.clicks_with_copies(spark, d),
        lambda m, path: stream_tables.sessions_writer(m, path, HALF_DAY_MS),
    )
    return flat(sinks.read_sessions(spark, out))


@query("stream_session_table")
def _stream_session_table(spark, d):
    out = _in_portions(
        spark, views.clicks_with_copies(spark, d),
        lambda m, path: stream_tables.sessions_writer(m, path, HALF_DAY_MS),
    )
    compacted = new_path(spark, "sessions")
    sinks.compact_sessions(spark, out, compacted)
    return flat(sinks.read_sessions(spark, compacted))


@query("compacted_events")
def _compacted_events(spark, d):
    out = _in_portions(spark, views.clicks_with_copies(spark, d), stream_tables.events_writer)
    compacted = new_path(spark, "events")
    sinks.compact_events(spark, out, compacted)
    return sinks.read_events(spark, compacted).select(*EVENT_KEY, "transaction_id")


@query("compacted_documents")
def _compacted_documents(spark, d):
    out = _in_portions(spark, views.clicks_with_copies(spark, d), stream_tables.documents_writer)
    compacted = new_path(spark, "documents")
    sinks.compact_documents(spark, out, compacted)
    return sinks.read_documents(spark, compacted)


@query("stream_documents")
def _stream_documents(spark, d):
    out = _in_portions(spark, views.clicks_with_copies(spark, d), stream_tables.documents_writer)
    return sinks.read_documents(spark, out)


@query("stream_events_over_time")
def _stream_events_over_time(spark, d):
    def counts(m, path):
        buckets = traffic.events_over_time(stream_tables.decoded_events(m))
        return stream_tables.to_sink(
            buckets, lambda b, i: b.write.mode("overwrite").parquet(f"{path}/batch_id={i}")
        )

    out = _in_portions(spark, views.clicks(spark, d), counts)
    # An updated bucket comes again with its new count; the latest holds.
    return flat(
        spark.read.parquet(out).groupBy("bucket").agg(
            F.max_by("events", "batch_id").alias("events")
        )
    )


@query("stream_closed_sessions")
def _stream_closed_sessions(spark, d):
    out = _in_portions(
        spark, views.clicks_with_copies(spark, d),
        lambda m, path: _to_parquet(
            stream_closed_sessions(stream_tables.decoded_events(m), HALF_DAY_MS), path
        ),
    )
    return flat(spark.read.parquet(out))


@query("stream_late_events")
def _stream_late_events(spark, d):
    """The earlier portion comes second: events of any age join a session or open the next."""
    out = _in_portions(
        spark, views.clicks(spark, d),
        lambda m, path: stream_tables.sessions_writer(m, path, HALF_DAY_MS), late=True,
    )
    return flat(sinks.read_sessions(spark, out).select(
        "session_id", "visitor_id", "session_start", "session_end", "event_count", "view_count",
        "cart_count", "transaction_count",
    ))


def _session_state(spark, d, **options) -> str:
    """Folder of the checkpoint of a session stream over both portions."""
    out = _in_portions(
        spark, views.clicks(spark, d),
        lambda m, path: stream_tables.sessions_writer(m, path, HALF_DAY_MS, **options),
    )
    return out.removesuffix("/out") + "/checkpoint"


@query("stream_state")
def _stream_state(spark, d):
    """Open sessions, read from the state of the stream."""
    return flat(stored_state(spark, _session_state(spark, d)))


@query("stream_state_active")
def _stream_state_active(spark, d):
    """What a time to live of two days has left in the state of the stream."""
    state = stored_state(spark, _session_state(spark, d, ttl_ms=2 * DAY_MS))
    return state.filter("last_activity > 0").select("visitor_id", "session_id", "last_activity", "event_count")


@query("stream_state_changes")
def _stream_state_changes(spark, d):
    """Changes of state by batch."""
    changes = state_changes(spark, _session_state(spark, d))
    return changes.groupBy("batch_id", "change_type").agg(
        F.count("*").alias("visitors"), F.sum("session.event_count").alias("events")
    )


FILES = 105  # more micro-batches than Spark keeps reports of


@query("stream_progress")
def _stream_progress(spark, d):
    """A micro-batch a file; sizes of all batches and counts of messages, from the stored reports."""
    base = new_path(spark, "stream")
    timed = _published(views.clicks(spark, d)).withColumn("portion", F.col("offset") % FILES)
    timed.repartition("portion").write.partitionBy("portion").parquet(f"{base}/messages")
    log = progress.ProgressLog(spark, f"{base}/progress")
    spark.streams.addListener(log)
    try:
        counted = progress.counted(streams.stream_source(spark, f"{base}/messages/*", max_per_batch=1))
        writer = counted.writeStream.queryName("clicks").format("noop")
        log.wait(streams.run_available(writer, f"{base}/checkpoint"))
    finally:
        spark.streams.removeListener(log)
    reports = stored(progress.read_progress(spark, f"{base}/progress"), "reports")
    sizes = progress.batch_metrics(reports).select("batch_id", "group_id", "batch_size")
    both = sizes.join(progress.produced(reports).drop("id"), "batch_id")
    return both.groupBy("group_id", "batch_size", "messages").agg(F.count("*").alias("batches"))


@query("stream_continuous_run")
def _continuous_run(spark, d):
    """A micro-batch an interval, stopped when all is processed."""
    base = new_path(spark, "stream")
    sinks.publish(_published(views.clicks(spark, d)), path=f"{base}/messages")
    events = stream_tables.decoded_events(streams.stream_source(spark, f"{base}/messages", max_per_batch=4))
    running = streams.run_continuously(_to_parquet(events, f"{base}/out"), f"{base}/checkpoint", "100 milliseconds")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(f"{base}/out").select("timestamp", "visitor_id", "event", "item_id")


@query("stream_csv_folder")
def _stream_csv_folder(spark, d):
    """CSV files by the library's own source; the later portion is read from the stored offsets."""
    base = new_path(spark, "stream")
    rows = views.raw_csv(spark, d).drop("seq")
    before = F.col("timestamp") < MIDDLE_MS
    for portion in (rows.filter(before), rows.filter(~before)):
        portion.write.mode("append").option("header", True).csv(f"{base}/files")
        read = stream_events_csv(spark, f"{base}/files", part_bytes=1 << 16)
        streams.run_available(_to_parquet(events.normalize_events(read), f"{base}/out"), f"{base}/checkpoint")
    return flat(spark.read.parquet(f"{base}/out"))


@query("stream_pipeline_tables")
def _pipeline_tables(spark, d):
    """All four streams under supervision, the catalog's tables filled from them, then a reset."""
    base, database = new_path(spark, "pipeline"), f"pathwake_{uuid.uuid4().hex}"
    sinks.publish(_published(views.all_events(spark, d).drop("event_type")), path=f"{base}/messages")
    with streams.state_partitions(spark):
        stream_tables.supervised_pipeline(
            streams.stream_source(spark, f"{base}/messages"), f"{base}/tables", f"{base}/progress", timeout_ms=HALF_DAY_MS
        )
    sinks.create_tables(spark, database)
    sinks.fill_tables(spark, database, f"{base}/tables")

    def counts(stage: str) -> DataFrame:
        tables = {name: spark.table(f"{database}.{name}") for name in sinks.TABLES}
        aside = f"{base}/tables/quarantine"
        if stage == "filled":
            tables |= {"documents": sinks.read_documents(spark, f"{base}/tables/documents"), "quarantine": spark.read.parquet(aside)}
        counted = traffic.table_counts(**tables)
        return stored(counted.withColumn("stage", F.lit(stage)), "counts")

    filled = counts("filled")
    sinks.reset_tables(spark, database, f"{base}/tables", f"{base}/progress")
    empty = counts("reset")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return filled.unionByName(empty)


@query("stream_failing_sink")
def _failing_sink(spark, d):
    """The event sink fails twice after writing; its stream goes on without loss or double rows."""
    base, left = new_path(spark, "stream"), [2]
    sinks.publish(_published(views.clicks_with_copies(spark, d)), path=f"{base}/messages")
    rows = stream_tables.decoded_events(streams.stream_source(spark, f"{base}/messages"))

    def store(batch, batch_id):
        sinks.insert_events(batch, batch_id, f"{base}/out")
        if left[0]:
            left[0] -= 1
            raise OSError("the sink went away")

    def start():
        return streams.run_available(stream_tables.to_sink(rows, store), f"{base}/checkpoint", wait=False)

    restarts = supervise({"events": start}, delay_sec=0.1)
    found = sinks.read_events(spark, f"{base}/out").select(*EVENT_KEY, "transaction_id")
    return found.withColumn("restarts", F.lit(restarts["events"]))


@query("results_csv")
def _results_csv(spark, d):
    """Two results with different columns appended to one CSV, then a third; one header, one layout."""
    path = new_path(spark, "results")
    runs = views.bench_runs(spark, d).selectExpr(
        "date_format(timestamp_millis(ts_ms), \"yyyy-MM-dd'T'HH:mm:ss\") AS timestamp", "environment",
        "impl AS consumer_impl", "partitions", "events_consumed", "duration_sec", "throughput AS throughput_events_sec",
    )
    sinks.append_results(
        path, runs.filter("partitions = 1").drop("duration_sec"), runs.filter("partitions = 2").drop("throughput_events_sec")
    )
    sinks.append_results(path, runs.filter("partitions > 2").drop("environment"))
    return files.scan_results_csv(spark, path).drop("timestamp")
