import pytest

from pathwake.functions.columns import iso_text
from pathwake.operators import events as E
from pathwake.operators import messages as M
from pyspark.sql import functions as F

EVENT = "timestamp long, visitor_id long, event string, item_id long, transaction_id long, seq long"


def test_transaction_id_text(spark):
    raw = spark.createDataFrame(
        [(0, 1, "view", 2, t) for t in ("", "0", "12", None, "x")],
        "timestamp long, visitorid long, event string, itemid long, transactionid string",
    )
    got = [r.transaction_id for r in E.normalize_events(raw).collect()]
    assert got == [None, None, 12, None, None]


def test_iso_text_drops_whole_second_fraction(spark):
    df = spark.createDataFrame([(0,), (1_500,), (-1,)], "ms long").select(iso_text(F.col("ms")))
    assert [r[0] for r in df.collect()] == [
        "1970-01-01T00:00:00+00:00",
        "1970-01-01T00:00:01.500000+00:00",
        "1969-12-31T23:59:59.999000+00:00",
    ]


def test_first_row_per_key_is_kept(spark):
    rows = [(1, 1, "view", 1, 9, 5), (1, 1, "view", 1, 8, 2), (1, 1, "view", 2, None, 3)]
    got = {r.item_id: (r.transaction_id, r.seq)
           for r in E.dedup_events(spark.createDataFrame(rows, EVENT)).collect()}
    assert got == {1: (8, 2), 2: (None, 3)}


def test_insert_skips_stored_keys(spark):
    batch = spark.createDataFrame([(1, 1, "view", 1, None, 0), (2, 1, "view", 1, None, 1)], EVENT)
    table = batch.filter("timestamp = 1")
    assert [r.timestamp for r in E.insert_new_events(batch, table).collect()] == [2]


def test_last_document_wins(spark):
    rows = [(1, 1, "transaction", 1, 5, 0), (1, 1, "transaction", 1, 6, 1)]
    got = E.index_documents(spark.createDataFrame(rows, EVENT)).collect()
    assert [(r.doc_id, r.transaction_id) for r in got] == [("1_1_transaction_1", 6)]


def test_validation_reasons(spark):
    raw = spark.createDataFrame(
        [("1", "2", "view", "3", None), ("x", None, "signup", "3", "y")],
        "timestamp string, visitor_id string, event string, item_id string, transaction_id string",
    )
    valid, rejected = E.split_valid_rejected(raw)
    assert valid.first().asDict() == {
        "timestamp": 1, "visitor_id": 2, "event": "view", "item_id": 3, "transaction_id": None,
    }
    assert rejected.first().reasons == ["timestamp", "visitor_id", "event", "transaction_id"]


FULL = '"timestamp":1,"visitor_id":2,"event":"view","item_id":3'


def _messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_unwrap_forms(spark):
    texts = [
        "{%s}" % FULL,
        '{"value":{%s}}' % FULL,
        '{"data":{%s}}' % FULL,
        '{"value":5,%s}' % FULL,
        '{"value":"{}",%s}' % FULL,
        '{"value":{"a":1},"data":{%s}}' % FULL,
        '{"timestamp":1,"visitor_id":2,"event":"view"}',
        '{"timestamp":1,"visitor_id":2,"event":"view","item_id":null}',
        "[1]", "oops", "null",
    ]
    got = [tuple(r) for r in M.unwrap_messages(_messages(spark, *texts)).collect()]
    full = (1, 2, "view", 3, None)
    assert got == [full] * 5 + [(1, 2, "view", None, None)]


def test_malformed_json_is_set_aside(spark):
    decoded = M.decode_messages(_messages(spark, "{%s}" % FULL, "oops", "[1]"))
    assert [r.corrupt for r in decoded.collect()] == [None, "oops", "[1]"]
    assert M.readable(decoded).count() == 1


def test_strict_decoding_fails(spark):
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        M.decode_messages(_messages(spark, "oops"), strict=True).collect()


def test_transport_errors_are_dropped(spark):
    df = spark.createDataFrame([("{}", "broken"), ("{%s}" % FULL, None)], "value string, error string")
    assert M.decode_messages(df).count() == 1


def test_published_visitor_stays_in_one_partition(spark):
    rows = spark.range(400).selectExpr(
        "id AS timestamp", "id % 20 AS visitor_id", "'view' AS event", "id AS item_id",
        "CAST(NULL AS BIGINT) AS transaction_id",
    )
    sent = M.publish_events(rows, partitions=4)
    spread = sent.groupBy("key").agg(F.countDistinct("partition").alias("n"))
    assert spread.filter("n > 1").count() == 0
    assert sent.select("partition").distinct().count() > 1
    assert '"transaction_id":null' in sent.first().value
    back = M.decode_messages(sent).select(*M.EVENT_FIELDS)
    assert back.exceptAll(rows.select(*M.EVENT_FIELDS)).count() == 0
