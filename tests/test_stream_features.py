"""Duplicates with late rows, closed sessions, the CSV source, supervision and the catalog."""

import pytest
from pyspark.sql import functions as F

from pathwake.sinks import tables as K
from pathwake.sources import partitioned
from pathwake.streaming import source as streams
from pathwake.streaming import tables as stream_tables
from pathwake.streaming.dedup import split_late, stream_dedup
from pathwake.streaming.sessions import stream_closed_sessions
from pathwake.streaming.supervision import GivenUp, supervise

HOUR = 3_600_000
COLUMNS = "timestamp long, visitor_id long, event string, item_id long, transaction_id long, seq long"


def folder_stream(spark, path):
    return spark.readStream.schema(COLUMNS).parquet(path)


def append(spark, path, rows):
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(path)


def test_first_rows_across_batches_and_late_rows(spark, tmp_path):
    out = []
    parts = [
        [(5, 1, "view", 1, 20, 2), (5, 1, "view", 1, 10, 1), (5, 1, "view", None, 30, 3), (None, 1, "view", 1, 1, 9)],
        [(5, 1, "view", 1, 40, 4), (6, 1, "view", 1, 41, 5), (100 * HOUR, 2, "view", 1, 50, 6)],
        [(101 * HOUR, 2, "view", 1, 51, 7)],
        [(5, 1, "view", 1, 60, 8), (5, 1, "view", 1, 61, 9), (99 * HOUR, 1, "view", 1, 62, 10), (100 * HOUR, 2, "view", 1, 63, 11)],
    ]
    for rows in parts:
        append(spark, f"{tmp_path}/in", rows)
        stream = stream_dedup(folder_stream(spark, f"{tmp_path}/in"), "2 hours")

        def store(batch, number):
            first, late = split_late(batch)
            out.append((sorted(r.transaction_id for r in first.collect()), sorted(r.transaction_id for r in late.collect())))

        with streams.state_partitions(spark, 2):
            streams.run_available(stream.writeStream.outputMode("append").foreachBatch(store), f"{tmp_path}/check")
    found = [part for part in out if part != ([], [])]
    assert found == [([10, 30], []), ([41, 50], []), ([51], []), ([62], [60, 61])]


def test_state_of_first_rows_does_not_grow_by_visitor(spark, tmp_path):
    """State calls cost by place, so many visitors share one; copies of a key stay single."""
    rows = [(60_000 + i % 7, i, "view", i % 3, i, i) for i in range(300)]
    for part in (rows[:200] + rows[:100], rows[100:]):
        append(spark, f"{tmp_path}/in", part)
        first = stream_dedup(folder_stream(spark, f"{tmp_path}/in"))
        writer = first.writeStream.format("parquet").option("path", f"{tmp_path}/out")
        with streams.state_partitions(spark, 2):
            streams.run_available(writer, f"{tmp_path}/check")
    assert sorted(r.seq for r in spark.read.parquet(f"{tmp_path}/out").filter("not late").collect()) == list(range(300))
    seen = spark.read.format("statestore").option("stateVarName", "seen").load(f"{tmp_path}/check")
    assert seen.select("key").distinct().count() <= 16


def test_closed_sessions_come_once(spark, tmp_path):
    parts = [
        [(1000, 1, "view", 2, None, 0), (2000, 1, "addtocart", 1, None, 1), (2000, 1, "view", 1, None, 2)],
        [(3000, 1, "view", 1, None, 3), (4001, 1, "view", 1, None, 4), (10_000, 2, "x", 1, None, 5)],
        [(90_000, 3, "view", 1, None, 6)],
    ]
    for rows in parts:
        append(spark, f"{tmp_path}/in", rows)
        closed = stream_closed_sessions(folder_stream(spark, f"{tmp_path}/in"), 1000, "1 second")
        writer = closed.writeStream.outputMode("append").format("parquet").option("path", f"{tmp_path}/out")
        with streams.state_partitions(spark, 2):
            streams.run_available(writer, f"{tmp_path}/check")
    got = sorted((r.visitor_id, r.session_start, r.session_end, r.event_count, r.items_viewed, r.items_carted)
                 for r in spark.read.parquet(f"{tmp_path}/out").collect())
    # A gap of exactly the timeout stays; one more opens the next; the newest is still open.
    assert got == [(1, 1000, 3000, 4, [1, 2], [1]), (1, 4001, 4001, 1, [1], []), (2, 10_000, 10_000, 1, [], [])]


@pytest.mark.parametrize("part_bytes", [7, 40, 1 << 20])
def test_csv_source_reads_growing_files(spark, tmp_path, part_bytes):
    files = tmp_path / "files"
    files.mkdir()
    header = "timestamp,visitorid,event,itemid,transactionid\n"
    lines = [f"{i},{i % 5},view,{i * 7},{'' if i % 3 else i}\n" for i in range(60)]
    (files / "a.csv").write_text(header + "".join(lines[:20]) + lines[20][:5])  # a line half written
    (files / "b.csv").write_text(header)
    (files / ".hidden.csv").write_text("x\n")

    def run():
        rows = partitioned.stream_events_csv(spark, str(files), part_bytes)
        writer = rows.writeStream.format("parquet").option("path", f"{tmp_path}/out")
        streams.run_available(writer, f"{tmp_path}/check")
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    want = [(i, i % 5, "view", i * 7, None if i % 3 else str(i)) for i in range(60)]
    assert run() == want[:20]
    with (files / "a.csv").open("a") as file:
        file.write(lines[20][5:] + "".join(lines[21:30]))
    with (files / "b.csv").open("a") as file:
        file.write("".join(lines[30:50]))
    (files / "c.csv").write_text(header + "".join(lines[50:]))
    assert run() == want
    assert run() == want  # nothing new


def test_csv_stretches_cut_at_any_byte():
    data = b"h\naa\nb\n\ncccc\nd\n"

    class Memory:
        def read_at(self, size, at):
            return data[at:at + size]

    for size in range(1, len(data) + 1):
        for first in (0, 2, 5):
            parts = [partitioned.Stretch("f", at, min(at + size, len(data)), len(data)) for at in range(first, len(data), size)]
            assert b"".join(partitioned._whole_lines(Memory(), p) for p in parts) == data[first:], (size, first)


def test_supervision_restarts_one_and_lets_others_go_on(spark, tmp_path):
    append(spark, f"{tmp_path}/in", [(i, 1, "view", i, None, i) for i in range(9)])
    left, seen = [2], []

    def failing(batch, number):
        K.insert_events(batch, number, f"{tmp_path}/events")
        if left[0]:
            left[0] -= 1
            raise OSError("away")

    def start(name, sink):
        stream = folder_stream(spark, f"{tmp_path}/in")
        return lambda: streams.run_available(stream_tables.to_sink(stream, sink), f"{tmp_path}/{name}", wait=False)

    starts = {"bad": start("bad", failing), "good": start("good", lambda b, i: seen.append(b.count()))}
    assert supervise(starts, delay_sec=0.05) == {"bad": 2, "good": 0}
    assert K.read_events(spark, f"{tmp_path}/events").count() == 9 and seen == [9]


def test_a_stream_that_never_works_is_given_up(spark, tmp_path):
    append(spark, f"{tmp_path}/in", [(1, 1, "view", 1, None, 1)])

    def broken(batch, number):
        raise OSError("never")

    stream = folder_stream(spark, f"{tmp_path}/in")
    start = lambda: streams.run_available(stream_tables.to_sink(stream, broken), f"{tmp_path}/check", wait=False)
    with pytest.raises(GivenUp) as caught:
        supervise({"broken": start}, attempts=3, delay_sec=0.01)
    assert set(caught.value.errors) == {"broken"}


def test_catalog_tables_are_filled_by_date_and_reset(spark, tmp_path):
    day = 24 * HOUR
    rows = [(i * day, 1, "view", i, None, i) for i in range(3)]
    folder = f"{tmp_path}/tables"
    K.insert_events(spark.createDataFrame(rows, COLUMNS), 0, f"{folder}/events")
    K.create_tables(spark, "filled")
    K.fill_tables(spark, "filled", folder)
    assert spark.table("filled.events").count() == 3 and spark.table("filled.item_metrics").count() == 3
    K.insert_events(spark.createDataFrame([(2 * day + 5, 1, "view", 9, None, 0)], COLUMNS), 1, f"{folder}/events")
    K.fill_tables(spark, "filled", folder, since="1970-01-03")
    found = spark.table("filled.events").groupBy("event_date").count().orderBy("event_date").collect()
    assert [(str(r[0]), r[1]) for r in found] == [("1970-01-01", 1), ("1970-01-02", 1), ("1970-01-03", 2)]
    assert spark.table("filled.item_metrics").count() == 4
    K.reset_tables(spark, "filled", folder)
    assert spark.table("filled.events").count() == 0 and K.read_events(spark, f"{folder}/events").count() == 0
    assert spark.table("filled.events").filter(F.col("event_time").isNull()).count() == 0
