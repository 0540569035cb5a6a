import datetime

import pytest

from pathwake.functions.columns import json_rows
from pathwake.operators import replay, sessions
from pathwake.operators.events import normalize_events
from pathwake.schemas import SESSION_TABLE
from pathwake.sinks import tables as K
from pathwake.sources import files

EVENT = "timestamp long, visitor_id long, event string, item_id long, transaction_id long, seq long"
RESULT = "timestamp string, run_id string, p0_lag long"


def session(spark, sid, start, events, items, end=50):
    at = lambda ms: datetime.datetime.fromtimestamp(ms / 1000, datetime.UTC)
    row = (sid, 1, at(start), at(end), 0, events, events, 0, 0, items, [], [], False)
    return spark.createDataFrame([row], SESSION_TABLE)


def test_upsert_keeps_start_and_replaces_lists(spark):
    old = session(spark, "1_1", 1000, 1, [1, 2]).unionByName(session(spark, "1_2", 5, 1, [9]))
    new = session(spark, "1_1", 9000, 4, [3]).unionByName(session(spark, "1_3", 7, 2, []))
    got = {r.session_id: r for r in K.upsert_sessions(old, new).collect()}
    assert set(got) == {"1_1", "1_2", "1_3"}
    assert got["1_1"].session_start == old.first().session_start
    assert got["1_1"].event_count == 4 and got["1_1"].items_viewed == [3]
    assert got["1_2"].items_viewed == [9]


def test_session_log_is_idempotent_and_compacts(spark, tmp_path):
    log, compact = f"{tmp_path}/log", f"{tmp_path}/compact"
    K.log_sessions(session(spark, "1_1", 1, 1, [1]), 0, log)
    K.log_sessions(session(spark, "1_1", 1, 2, [1, 2]), 1, log)
    K.log_sessions(session(spark, "1_1", 1, 2, [1, 2]), 1, log)
    assert [r.event_count for r in K.read_sessions(spark, log).collect()] == [2]
    K.compact_sessions(spark, log, compact)
    K.log_sessions(session(spark, "1_1", 1, 3, [1, 2, 3]), 2, compact)
    assert [r.items_viewed for r in K.read_sessions(spark, compact).collect()] == [[1, 2, 3]]


def test_inserted_events_are_idempotent(spark, tmp_path):
    path = f"{tmp_path}/events"
    first = spark.createDataFrame([(1, 1, "view", 1, None, 0), (1, 1, "view", 1, 7, 1)], EVENT)
    second = spark.createDataFrame(
        [(1, 1, "view", 1, 9, 0), (86_400_001, 1, "view", 1, 5, 1)], EVENT)
    for batch_id, batch in ((0, first), (0, first), (1, second), (1, second)):
        K.insert_events(batch, batch_id, path)
    got = sorted((r.timestamp, r.transaction_id) for r in K.read_events(spark, path).collect())
    assert got == [(1, None), (86_400_001, 5)]


def test_compacted_tables_are_added_to(spark, tmp_path):
    def batch(*rows):
        return spark.createDataFrame([(ts, 1, "view", 1, paid, 0) for ts, paid in rows], EVENT)

    events, docs, small, few = (f"{tmp_path}/{n}" for n in ("events", "docs", "small", "few"))
    for batch_id, rows in enumerate((batch((1, 5), (2, None)), batch((1, 6), (86_400_001, 7)))):
        K.insert_events(rows, batch_id, events)
        K.index_batch(rows, batch_id, docs)
    K.compact_events(spark, events, small)
    K.compact_documents(spark, docs, few)
    K.insert_events(batch((1, 6), (86_400_001, 7)), 1, small)  # a replayed batch
    K.insert_events(batch((2, 8), (3, 9)), 2, small)
    K.index_batch(batch((2, 8), (3, 9)), 2, few)

    def stored(table):
        return sorted((r.timestamp, r.transaction_id) for r in table.collect())

    assert stored(K.read_events(spark, small)) == [(1, 5), (2, None), (3, 9), (86_400_001, 7)]
    assert stored(K.read_documents(spark, few)) == [(1, 6), (2, 8), (3, 9), (86_400_001, 7)]


def test_a_second_stream_keeps_stored_rows(spark, tmp_path):
    events, log, docs = (f"{tmp_path}/{n}" for n in ("events", "log", "docs"))
    for number, stream in enumerate(("first", "second")):
        batch = spark.createDataFrame([(number, 1, "view", 1, number, 0), (9, 1, "view", 1, number, 1)], EVENT)
        for _ in range(2):  # each batch is replayed once
            K.insert_events(batch, 0, events, stream)
            K.log_sessions(session(spark, f"{number}_1", 1, 1, [1]), 0, log, stream)
            K.index_batch(batch, 0, docs, stream)
    got = sorted((r.timestamp, r.transaction_id) for r in K.read_events(spark, events).collect())
    assert got == [(0, 0), (1, 1), (9, 0)]
    assert {r.session_id for r in K.read_sessions(spark, log).collect()} == {"0_1", "1_1"}
    assert K.read_documents(spark, docs).count() == 3


def test_documents_last_batch_wins(spark, tmp_path):
    path = f"{tmp_path}/docs"
    for batch_id, tid in ((0, 5), (1, 6)):
        K.index_batch(
            spark.createDataFrame([(1, 1, "transaction", 1, tid, 0)], EVENT), batch_id, path)
    assert [r.transaction_id for r in K.read_documents(spark, path).collect()] == [6]


def test_events_csv_round_trip(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(
        "timestamp,visitorid,event,itemid,transactionid\n"
        "2,7,view,30,\n1,7,transaction,31,12\n3,8,addtocart,32,0\n"
    )
    events = normalize_events(files.scan_events_csv(spark, str(path)))
    got = [(r.timestamp, r.item_id, r.transaction_id)
           for r in events.orderBy("timestamp").collect()]
    assert got == [(1, 31, 12), (2, 30, None), (3, 32, None)]
    assert replay.slice_events(events.withColumnRenamed("item_id", "seq"), 0, 0).count() == 3
    assert sessions.sessionize(events).count() == 2


def test_results_append_with_one_layout(spark, tmp_path):
    path = f"{tmp_path}/ramp"
    a = spark.createDataFrame([("2026-01-25T10:00:00", "r", 1)], RESULT)
    b = spark.createDataFrame([("2026-01-25T10:00:05", "r", 2)],
                              "timestamp string, run_id string, p1_lag long")
    K.append_results(path, a, b)
    K.append_results(path, a)
    rows = files.scan_results_csv(spark, path)
    assert rows.columns == ["timestamp", "run_id", "p0_lag", "p1_lag", "ts_ms"]
    got = sorted((r.timestamp[-2:], r.p0_lag, r.p1_lag) for r in rows.collect())
    assert got == [("00", "1", None), ("00", "1", None), ("05", None, "2")]
    with pytest.raises(ValueError, match="p9_lag"):
        K.append_results(path, a.withColumnRenamed("p0_lag", "p9_lag"))


def test_unreadable_result_times_are_skipped(spark, tmp_path):
    path = tmp_path / "runs.csv"
    path.write_text(
        "timestamp,environment,throughput_events_sec\n2026-01-25T10:00:00,local,5\nsoon,local,6\n")
    got = files.scan_results_csv(spark, str(path)).collect()
    assert [r.throughput_events_sec for r in got] == [5]


def test_tables_are_created_once_and_reset(spark):
    K.create_tables(spark, "shop")
    K.create_tables(spark, "shop")
    spark.sql("INSERT INTO shop.item_metrics VALUES (1, 1, 1, 1, 1, current_timestamp(), "
              "current_timestamp())")
    assert spark.table("shop.item_metrics").count() == 1
    K.reset_tables(spark, "shop")
    assert spark.table("shop.item_metrics").count() == 0
    assert spark.table("shop.sessions").schema.names == SESSION_TABLE.names


def test_publishing_counts_messages(spark, tmp_path):
    sent = spark.range(7).selectExpr("CAST(id AS STRING) AS key", "'{}' AS value")
    assert K.publish(sent, path=f"{tmp_path}/out") == 7
    assert spark.read.parquet(f"{tmp_path}/out").count() == 7


def test_report_as_json(spark):
    report = spark.createDataFrame([("g", None)], "group_id string, consumer_lag long")
    assert json_rows(report).first().json == '{"group_id":"g","consumer_lag":null}'
