"""Streams against the batch operators and the plain fold."""

import datetime
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pathwake.operators import messages as M
from pathwake.operators import sessions as S
from pathwake.sinks import tables as K
from pathwake.operators import batches, lag
from pathwake.streaming import progress
from pathwake.streaming import sessions as stream_module
from pathwake.streaming import source as streams
from pathwake.streaming import tables as stream_tables
from pathwake.streaming.sessions import stored_state, stream_sessions
from tests.fold import fold, random_events

COLUMNS = "timestamp long, visitor_id long, event string, item_id long, seq long"


class Stream:
    """A folder of event files and a session stream over it, run batch by batch."""

    def __init__(self, spark, base, timeout=1000, **options):
        self.spark, self.base = spark, str(base)
        self.timeout, self.options = timeout, options

    def run(self, rows):
        """Add rows as one file, run what is available, return the emitted sessions."""
        df = self.spark.createDataFrame(rows, COLUMNS).coalesce(1)
        df.write.mode("append").parquet(f"{self.base}/in")
        emitted = []
        events = self.spark.readStream.schema(df.schema).parquet(f"{self.base}/in")
        sessions = stream_sessions(events, self.timeout, **self.options)
        writer = stream_tables.to_sink(
            sessions, lambda b, i: emitted.extend(r.asDict() for r in b.collect()))
        self.query = streams.run_available(writer, f"{self.base}/checkpoint")
        return emitted


@pytest.mark.parametrize("seed", [0, 1])
def test_any_split_equals_the_fold(spark, tmp_path, seed):
    """Batches in arrival order, with late events inside and across batches."""
    rows = random_events(seed, n=150)
    rng = random.Random(seed)
    late = [(max(1, ts - rng.choice([0, 0, 0, 700, 5000])), v, k, i, s) for ts, v, k, i, s in rows]
    stream, state, want, got = Stream(spark, tmp_path), {}, {}, {}
    for part in (late[:50], late[50:60], late[60:]):
        touched, state = fold(part, 1000, state)
        want.update({k: _copy(s) for k, s in touched.items()})
        got.update({s["session_id"]: s for s in stream.run(part)})
    assert got == want


def _copy(session):
    return {k: list(v) if isinstance(v, list) else v for k, v in session.items()}


def test_both_sessions_of_a_batch_and_a_late_event(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    first = stream.run([(1000, 7, "view", 1, 0), (2000, 7, "view", None, 1), (9000, 7, "x", 2, 2)])
    assert [(s["session_id"], s["items_viewed"]) for s in first] == [
        ("7_1", [1, None]), ("7_2", [])]
    late = stream.run([(8500, 7, "view", 2, 3)])
    assert [(s["session_id"], s["session_start"], s["session_end"], s["last_activity"],
             s["event_count"]) for s in late] == [("7_2", 9000, 9000, 8500, 2)]


@pytest.mark.parametrize("held", [3, 10**6])
def test_a_task_combines_its_batches(monkeypatch, held):
    """One visitor holding most rows sends one row per slot, type and item of a whole task."""
    monkeypatch.setattr(stream_module, "MERGE_ROWS", 2)
    monkeypatch.setattr(stream_module, "HELD_ROWS", held)
    rng = random.Random(held)
    rows = [
        {"visitor_id": rng.choice([1, 1, 1, 2]), "slot": ts // 50, "event": rng.choice(["view", "addtocart"]),
         "item_id": rng.choice([None, 7, 8]), "timestamp": ts, "seq": i}
        for i, ts in enumerate(rng.choices(range(100), k=400))
    ]
    layout = pa.schema([(n, pa.string() if n == "event" else pa.int64()) for n in rows[0]])
    batches_in = [pa.RecordBatch.from_pylist(rows[i:i + 30], layout) for i in range(0, 400, 30)]
    out = [r for b in stream_module.combine(iter(batches_in)) for r in b.to_pylist()]
    got = {}
    for row in out:
        for slot, ts, seq, item, kind, n, last in zip(*(row[c] for c in stream_module._LISTS)):
            key = row["visitor_id"], slot, kind, item
            total, first, latest = got.get(key, (0, (ts, seq), last))
            got[key] = total + n, min(first, (ts, seq)), max(latest, last)
    want = {}
    for r in rows:
        want.setdefault((r["visitor_id"], r["slot"], r["event"], r["item_id"]), []).append((r["timestamp"], r["seq"]))
    assert got == {k: (len(v), min(v), max(v)[0]) for k, v in want.items()}
    if held > 400:
        assert [r["visitor_id"] for r in out].count(1) == 1


def test_a_task_holds_few_combined_rows():
    """What a task holds, and sends at once, does not grow with what it reads."""
    names = ["visitor_id", "slot", "event", "item_id", "timestamp", "seq"]

    def read(numbers):
        ids = pa.array(numbers, pa.int64())
        return pa.RecordBatch.from_arrays([ids, ids, pa.array(["view"] * len(ids)), ids, ids, ids], names)

    batches_in = (read(range(i, i + 10_000)) for i in range(0, 300_000, 10_000))
    sent = [sum(map(len, b["slot"].to_pylist())) for b in stream_module.combine(batches_in)]
    assert sum(sent) == 300_000 and max(sent) <= 80_000


def test_neighbouring_visitors_share_a_place_of_state(spark, tmp_path):
    """State calls go by place, not by visitor; each visitor's session changes by itself."""
    stream = Stream(spark, tmp_path)
    first = stream.run([(1000 + v, v, "view", v, v) for v in range(-20, 100)])
    assert len(first) == 120
    assert sum(s.numRowsUpdated for s in stream.query.lastProgress.stateOperators) <= 16
    again = stream.run([(1500, 7, "view", 5, 200), (9000, 8, "view", 5, 201)])
    assert sorted((s["session_id"], s["event_count"]) for s in again) == [("7_1", 2), ("8_2", 1)]
    state = {r.visitor_id: r.session_id for r in stored_state(spark, f"{tmp_path}/checkpoint").collect()}
    assert state == {v: f"{v}_{2 if v == 8 else 1}" for v in range(-20, 100)}
    changes = stream_module.state_changes(spark, f"{tmp_path}/checkpoint")
    assert changes.filter("batch_id = 0").count() == 120
    assert sorted(r.visitor_id for r in changes.filter("batch_id = 1").collect()) == [7, 8]


def test_sessions_of_a_place_run_out_one_by_one(spark, tmp_path):
    stream = Stream(spark, tmp_path, ttl_ms=5000, late_after="1 second")

    def live():
        state = stored_state(spark, f"{tmp_path}/checkpoint").filter("event_count > 0")
        return sorted(r.visitor_id for r in state.collect())

    stream.run([(1000, 1, "view", 1, 0), (4000, 2, "view", 1, 1), (30_000, 3, "view", 1, 2)])
    stream.run([(8500, 40, "view", 1, 3)])  # an old event leaves event time at 29,000
    stream.run([(30_001, 40, "view", 1, 4)])
    assert live() == [3, 40]
    stream.run([(37_000, 50, "view", 1, 5)])
    stream.run([(37_001, 50, "view", 1, 6)])
    assert live() == [50]
    assert [s["session_id"] for s in stream.run([(38_000, 2, "view", 1, 7)])] == ["2_2"]
    assert live() == [2, 50]


def test_expired_state_keeps_its_number(spark, tmp_path):
    stream = Stream(spark, tmp_path, ttl_ms=5000, late_after="1 second")
    stream.run([(1000, 7, "view", 1, 0)])
    stream.run([(90_000, 8, "view", 1, 1)])  # moves event time past the first visitor's life
    stream.run([(91_000, 8, "view", 1, 2)])
    assert [s["session_id"] for s in stream.run([(92_000, 7, "view", 1, 3)])] == ["7_2"]


def test_late_events_are_kept_with_a_time_to_live(spark, tmp_path):
    base, day = str(tmp_path), 86_400_000
    parts = [
        [(10 * day, 7, "view", 1, 0), (10 * day, 9, "view", 1, 1)],
        [(20 * day, 8, "view", 1, 2)],
        [(20 * day + 1, 8, "view", 1, 3)],
        [(10 * day + 500, 7, "view", 2, 4), (5 * day, 6, "view", 3, 5), (10 * day + 9, 8, "view", 4, 6)],
    ]
    for rows in parts:
        events = spark.createDataFrame(rows, COLUMNS).withColumn(
            "transaction_id", F.lit(None).cast("bigint"))
        sent = M.publish_events(events).coalesce(1).withColumn("timestamp", F.current_timestamp())
        K.publish(sent.withColumnRenamed("seq", "offset"), path=f"{base}/in")
        writer = stream_tables.sessions_writer(
            streams.stream_source(spark, f"{base}/in"), f"{base}/sessions", 1000, 5 * day)
        streams.run_available(writer, f"{base}/checkpoint")
    got = K.read_sessions(spark, f"{base}/sessions").collect()
    # The state of visitor 7 was cleared, that of visitor 8 is open.
    assert {r.session_id: r.event_count for r in got} == {
        "7_1": 1, "9_1": 1, "8_1": 3, "7_2": 1, "6_1": 1}
    state = {r.visitor_id: r.last_activity for r in stored_state(spark, f"{base}/checkpoint").collect()}
    assert state[9] == 0


def test_tables_after_restart_equal_batch(spark, tmp_path):
    """Three readers of one stream, stopped and resumed; a replayed batch changes nothing."""
    rows = sorted(random_events(5, n=120), key=lambda e: (e[0], e[4]))
    base, timed = str(tmp_path), spark.createDataFrame(rows, COLUMNS).withColumn(
        "transaction_id", F.lit(None).cast("bigint"))
    for low, high in ((0, 40), (40, 41), (41, 120)):
        seqs = [r[4] for r in rows[low:high]]
        part = M.publish_events(timed.filter(F.col("seq").isin(seqs))).coalesce(1)
        sent = part.withColumn("timestamp", F.current_timestamp()).withColumnRenamed(
            "seq", "offset")
        K.publish(sent, path=f"{base}/in")
        for name, make in (
            ("events", stream_tables.events_writer),
            ("documents", stream_tables.documents_writer),
            ("sessions", lambda m, p: stream_tables.sessions_writer(m, p, 1000)),
        ):
            writer = make(streams.stream_source(spark, f"{base}/in"), f"{base}/{name}")
            streams.run_available(writer, f"{base}/checkpoint_{name}")
    known = timed.filter(F.col("event").isin("view", "addtocart", "transaction"))
    want = S.to_table(S.sessionize(timed, 1000))  # unknown types count in sessions
    got = K.read_sessions(spark, f"{base}/sessions")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    keys = known.select("visitor_id", "timestamp", "event", "item_id").distinct().count()
    assert K.read_events(spark, f"{base}/events").count() == keys
    assert K.read_documents(spark, f"{base}/documents").count() == keys


def test_bad_messages_do_not_reach_the_tables(spark):
    df = spark.createDataFrame([(0, "oops"), (1, '{"timestamp":1,"visitor_id":1}')],
                               "offset long, value string")
    assert stream_tables.decoded_events(df).count() == 0


def test_continuous_run(spark, tmp_path):
    spark.range(5).selectExpr("CAST(id AS STRING) AS key", "'{}' AS value").write.parquet(
        f"{tmp_path}/in")
    writer = streams.stream_source(spark, f"{tmp_path}/in", max_per_batch=1).writeStream.format(
        "memory").queryName("continuous")
    query = streams.run_continuously(writer, f"{tmp_path}/checkpoint", "100 milliseconds")
    query.processAllAvailable()
    query.stop()
    assert spark.table("continuous").count() == 5


def test_state_and_measurements_of_a_stream(spark, tmp_path):
    rows = sorted(random_events(7, n=80), key=lambda e: (e[0], e[4]))
    stream = Stream(spark, tmp_path)
    stream.run(rows)
    state = stored_state(spark, f"{tmp_path}/checkpoint")
    want = S.latest_state(S.sessionize(spark.createDataFrame(rows, COLUMNS), 1000))
    assert state.exceptAll(want).count() == want.exceptAll(state).count() == 0
    assert S.active_sessions(state, F.lit(0), 1).first()[0] == want.count()


def test_every_batch_of_a_stream_is_measured(spark, tmp_path):
    """More batches than Spark keeps, restarted in between; a joined file and single ones."""
    rows = sorted(random_events(7, n=80), key=lambda e: (e[0], e[4]))
    log = progress.ProgressLog(spark, f"{tmp_path}/progress")
    spark.streams.addListener(log)
    try:
        for part in (rows[:50], rows[50:]):
            many = spark.createDataFrame(part + part[:15], COLUMNS).coalesce(1)  # a file a row
            many.write.option("maxRecordsPerFile", 1).mode("append").parquet(f"{tmp_path}/in")
            events = spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
            writer = progress.counted(events).writeStream.queryName("numbers").format("noop")
            assert log.wait(streams.run_available(writer, f"{tmp_path}/checkpoint"))
        stream = Stream(spark, tmp_path / "state")
        stream.run(rows)
        assert log.wait(stream.query)
    finally:
        spark.streams.removeListener(log)
    reports = progress.read_progress(spark, f"{tmp_path}/progress")
    measured = progress.batch_metrics(reports, 100)
    plain = measured.filter("group_id = 'numbers'")
    assert plain.count() == 110 and plain.filter("batch_size <> 1 or pg_events_ms = 0 and poll_ms = 0").count() == 0
    assert progress.produced(reports).agg(F.sum("messages"), F.count("*")).first() == (110, 110)
    row = measured.filter("group_id is null or group_id <> 'numbers'").orderBy(F.desc("batch_size")).first()
    assert row.batch_size == 80 and row.valkey_ms > 0 and row.pg_events_ms == 0
    assert batches.batch_summary(measured, None).agg(F.sum("events")).first()[0] == 190
    assert progress.offsets(reports).count() == 0


def test_offsets_of_a_broker_source(spark, tmp_path):
    def report(batch, reached, newest, time):
        sources = [{"endOffset": reached, "latestOffset": newest}]
        return json.dumps({"id": "q", "batchId": batch, "timestamp": time, "sources": sources}) + "\n"

    times = ["2024-01-01T00:00:01.000Z", "2024-01-01T00:00:02.000Z"]
    (tmp_path / "a.json").write_text(
        report(0, {"t": {"0": 1}}, {"t": {"0": 9}}, times[0]) + report(1, {"t": {"0": 4, "1": 7}}, None, times[0]))
    (tmp_path / "b.json").write_text(report(1, {"t": {"0": 5, "1": 7}}, {"t": {"0": 9}}, times[1]))
    df = progress.offsets(progress.read_progress(spark, str(tmp_path)))
    assert sorted(tuple(r) for r in df.collect()) == [("q", "t", 0, 5, 9), ("q", "t", 1, 7, None)]
    lags = lag.live_lag(df.drop("end_offset"), df.select("topic", "part", "end_offset"))
    assert {r.part: r.lag for r in lags.collect()} == {0: 4, 1: None}


def test_pipeline_sets_aside_what_it_does_not_store(spark, tmp_path):
    def message(i, value):
        return ("1", value, "events", 0, i, datetime.datetime(2024, 1, 1))

    event = {"timestamp": 1000, "visitor_id": 1, "event": "view", "item_id": 5, "transaction_id": None}
    values = [json.dumps(event), json.dumps(event), json.dumps(event | {"event": "signup"}), "oops", json.dumps(event | {"timestamp": 2000})]
    rows = [message(i, v) for i, v in enumerate(values)]
    layout = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
    spark.createDataFrame(rows, layout).write.parquet(f"{tmp_path}/in")
    messages = streams.stream_source(spark, f"{tmp_path}/in")
    with streams.state_partitions(spark, 2):
        stream_tables.session_pipeline(messages, f"{tmp_path}/out", f"{tmp_path}/progress")
    assert K.read_events(spark, f"{tmp_path}/out/events").count() == 2
    assert [r.event_count for r in K.read_sessions(spark, f"{tmp_path}/out/sessions").collect()] == [4]
    aside = spark.read.parquet(f"{tmp_path}/out/quarantine").orderBy("offset").collect()
    assert [r.offset for r in aside] == [2, 3] and aside[1].reasons == ["unreadable"]
