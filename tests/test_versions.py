"""Versioned tables: folding, crashes, concurrent folds, pruned lookups, clocks."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pathwake.schemas import EVENT_KEY
from pathwake.sinks import tables as K
from pathwake.sinks import versions as V
from tests.test_sinks import session

EVENT = "timestamp long, visitor_id long, event string, item_id long, transaction_id long, seq long"
DAY = 86_400_000


def batch(spark, *rows):
    return spark.createDataFrame([(ts, 1, "view", 1, paid, i) for i, (ts, paid) in enumerate(rows)], EVENT)


def stored(table):
    return sorted((r.timestamp, r.transaction_id) for r in table.collect())


def test_batches_are_folded_and_levels_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "FOLD_AFTER", 2)
    monkeypatch.setattr(V, "WIDTH", 2)
    monkeypatch.setattr(V, "KEEP_MS", 0)
    path = f"{tmp_path}/docs"
    for i in range(9):
        K.index_batch(batch(spark, (1, i), (100 + i, i)), i, path)
    table = K.document_table(spark, path)
    version = table.version()
    assert version.folded == {"main": 7} and [level for level, _ in version.runs] == [2]
    assert stored(K.read_documents(spark, path)) == sorted([(1, 8), *((100 + i, i) for i in range(9))])
    table.remove_unused(keep_ms=0)
    left = table.files.names(f"{path}/rows")
    assert len(left) == 2 and table.batches() == [("main", 8)]
    K.index_batch(batch(spark, (1, 3), (103, 3)), 3, path)  # a folded batch comes again
    assert stored(K.read_documents(spark, path)) == sorted([(1, 8), *((100 + i, i) for i in range(9))])


def test_a_crash_before_the_switch_loses_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/events"
    for i in range(3):
        K.insert_events(batch(spark, (i, i), (DAY + i, i)), i, path)
    table = K.event_table(spark, path)
    before = stored(table.read())
    monkeypatch.setattr(V.Files, "write_new", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        table.fold()
    assert stored(table.read()) == before and table.version().number == 0
    monkeypatch.undo()
    assert table.fold() and stored(table.read()) == before and table.version().number == 1
    assert not table.fold()  # nothing since


def test_of_two_folds_one_counts(spark, tmp_path):
    path = f"{tmp_path}/events"
    K.insert_events(batch(spark, (1, 1)), 0, path)
    first, second = K.event_table(spark, path), K.event_table(spark, path)
    assert first.fold()
    second.version = lambda before=None: V.Version()  # it had begun before the first ended
    assert not second.fold()
    assert stored(first.read()) == [(1, 1)]
    files = V.Files(spark, path)
    assert files.write_new(f"{path}/pointer/x.json", "a") and not files.write_new(f"{path}/pointer/x.json", "b")
    assert files.read(f"{path}/pointer/x.json") == "a"


@pytest.mark.parametrize("seed", range(3))
def test_sessions_do_not_depend_on_how_versions_were_grouped(spark, tmp_path, seed):
    """Two streams' versions in any order, merged in three parts and then together."""
    rng = random.Random(seed)
    versions = [("a", i, i + 1, 10 * i + 5) for i in range(5)] + [("b", i, i + 3, 10 * i + 7) for i in range(5)]
    rng.shuffle(versions)
    plain = f"{tmp_path}/plain"
    for stream, number, count, end in versions:
        K.log_sessions(session(spark, "1_1", 1000 + number, count, [number], end), number, plain, stream)
    want = K.read_sessions(spark, plain).first()
    assert want.event_count == 7 and want.items_viewed == [4] and want.session_start.timestamp() * 1000 == 1000
    parts = K.session_table(spark, plain).rows().withColumn("part", F.expr(f"pmod(hash(event_count + {seed}), 3)"))
    grouped = None
    for part in range(3):
        merged = K._merge_versions(parts.filter(F.col("part") == part).drop("part"))
        grouped = merged if grouped is None else grouped.unionByName(merged)
    assert K._merge_versions(grouped).drop("born", "version").first() == want


def test_lookups_read_only_the_dates_and_times_of_the_batch(spark, tmp_path):
    path = f"{tmp_path}/events"
    many = spark.range(150).selectExpr(
        f"id * {DAY} as timestamp", "1L as visitor_id", "'view' as event", "1L as item_id", "id as transaction_id", "id as seq")
    K.insert_events(many, 0, path)
    table = K.event_table(spark, path)
    table.fold()
    K.insert_events(batch(spark, (5 * DAY, 0), (5 * DAY + 1, 0), (140 * DAY, 0)), 1, path)
    assert table.read().count() == 151
    again = batch(spark, (5 * DAY, 0), (7 * DAY + 5, 0))
    lookup = K.stored_keys(again, table.rows()).select(*EVENT_KEY)
    length = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(length)
    spark.conf.set(length, "10000")
    text = lookup._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(length, before)
    pruned, pushed = (re.search(rf"{kind}Filters: (.*)", text).group(1) for kind in ("Partition", "Pushed"))
    assert "event_date" in pruned.split("PushedFilters")[0] and "1970-01-06" in pruned
    assert f"GreaterThanOrEqual(timestamp,{5 * DAY})" in pushed
    files = {r[0].rsplit("event_date=", 1)[1][:10] for r in lookup.select(F.input_file_name()).collect()}
    assert files == {"1970-01-06"}
    lookup.collect()
    scan = lookup._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() <= 3


def test_many_dates_are_one_range(spark, tmp_path):
    path = f"{tmp_path}/events"
    rows = [(i * DAY, i) for i in range(K.MANY_DATES + 10)]
    K.insert_events(batch(spark, *rows), 0, path)
    K.insert_events(batch(spark, *rows, (3, 3)), 1, path)
    assert stored(K.read_events(spark, path)) == sorted([*rows, (3, 3)])


def test_stream_names_with_signs(spark, tmp_path):
    path = f"{tmp_path}/docs"
    K.index_batch(batch(spark, (1, 1)), 0, path, "a.b/c=d e%")
    K.index_batch(batch(spark, (1, 2)), 0, path, "z")
    table = K.document_table(spark, path)
    assert table.batches() == [("a.b/c=d e%", 0), ("z", 0)]
    table.fold()
    assert stored(K.read_documents(spark, path)) == [(1, 2)]


def test_documents_are_exported_with_nulls(spark, tmp_path):
    K.index_batch(batch(spark, (1, None)), 0, f"{tmp_path}/docs")
    K.export_documents(spark, f"{tmp_path}/docs", f"{tmp_path}/json")
    assert '"transaction_id":null' in spark.read.text(f"{tmp_path}/json").first().value
