import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathwake.operators import replay
from pathwake.operators.ordering import over_recent_rows, running, with_position


@pytest.fixture(scope="module")
def rows(spark):
    """One group holds most rows; some values are null."""
    rng = random.Random(3)
    data = [
        (1 if rng.random() < 0.8 else rng.choice([2, 3, None]), rng.randrange(50), i,
         None if rng.random() < 0.3 else rng.randrange(10))
        for i in range(900)
    ]
    return spark.createDataFrame(data, "k long, ts long, seq long, v long").repartition(7)


def expected(rows, column):
    window = W.partitionBy("k").orderBy("ts", "seq")
    return {r.seq: r[1] for r in rows.select("seq", column(window)).collect()}


def got(df, name):
    return {r.seq: r[name] for r in df.collect()}


def test_positions_by_group(rows):
    want = expected(rows, lambda w: F.row_number().over(w) - 1)
    assert got(with_position(rows, ["k"], ["ts", "seq"]), "position") == want


def test_positions_of_the_whole_table(rows):
    result = with_position(rows, [], ["ts", "seq"]).orderBy("ts", "seq").collect()
    assert [r.position for r in result] == list(range(900))


@pytest.mark.parametrize("block", [7, 64, 10_000])
def test_recent_rows(rows, block):
    positioned = with_position(rows, ["k"], ["ts", "seq"])
    result = over_recent_rows(
        positioned, ["k"],
        lambda df, w: df.withColumn("s", F.sum("v").over(w.rowsBetween(-5, 0))), 5, block,
    )
    assert result.count() == 900
    assert got(result, "s") == expected(rows, lambda w: F.sum("v").over(w.rowsBetween(-5, 0)))


@pytest.mark.parametrize("block", [7, 64, 10_000])
def test_running(rows, block):
    positioned = with_position(rows, ["k"], ["ts", "seq"])
    result = running(
        positioned, ["k"], {"total": ("sum", F.col("v")), "known": ("last", F.col("v"))}, block
    )
    upto = lambda w: w.rowsBetween(W.unboundedPreceding, 0)
    assert got(result, "total") == expected(
        rows, lambda w: F.coalesce(F.sum("v").over(upto(w)), F.lit(0)))
    assert got(result, "known") == expected(
        rows, lambda w: F.last("v", ignorenulls=True).over(upto(w)))


def test_slices(spark):
    events = spark.range(50).selectExpr("50 - id AS timestamp", "id AS seq").repartition(5)
    times = lambda df: sorted(r.timestamp for r in df.collect())
    assert times(replay.slice_events(events)) == list(range(1, 51))
    assert times(replay.slice_events(events, 0, 3)) == [1, 2, 3]
    assert times(replay.slice_events(events, 10)) == list(range(11, 51))
    assert times(replay.slice_events(events, 10, 5)) == list(range(11, 16))
    assert times(replay.slice_events(events, 10, 5, page_rows=14)) == list(range(11, 16))
    assert times(replay.slice_events(events, 0, 3, page_rows=2)) == [1, 2, 3]
    assert "TakeOrderedAndProject" in replay.slice_events(events, 10, 5)._jdf.queryExecution().toString()


def test_replay_speed(spark):
    events = spark.createDataFrame([(3000,), (1000,), (2000,)], "timestamp long")
    got = replay.replay_schedule(events, 2.0).collect()
    assert [r.release_sec for r in got] == [1.0, 0.0, 0.5]


@pytest.mark.parametrize("rate,burst", [(50.0, None), (50.0, 1), (7.0, 3)])
def test_token_bucket(spark, rate, burst):
    events = spark.range(300).selectExpr("id AS timestamp", "id AS seq")
    got = [r.release_sec for r in
           replay.rate_limited_schedule(events, rate, burst).orderBy("seq").collect()]
    size = replay.default_burst(rate) if burst is None else burst
    tokens, clock, want = float(size), 0.0, []
    for _ in range(300):
        wait = max(0.0, (1 - tokens) / rate)
        clock += wait
        tokens = min(size, tokens + wait * rate) - 1
        want.append(clock)
    assert got == pytest.approx(want)


def test_default_burst():
    assert replay.default_burst(10) == 100 and replay.default_burst(5000) == 500


def test_rates_must_be_positive(spark):
    with pytest.raises(ValueError):
        replay.rate_limited_schedule(spark.range(1), 0)
    with pytest.raises(ValueError):
        replay.replay_schedule(spark.range(1), 0)
