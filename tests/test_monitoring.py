import random

import pytest

from pathwake.operators import batches as B
from pathwake.operators import benchmarks as N
from pathwake.operators import lag as L

SAMPLES = "group_id string, instance long, ts long, part long, lag long, seq long"


def samples(spark, series, group="g"):
    rows = [(group, 0, ts, 0, lag, i) for i, (ts, lag) in enumerate(series)]
    return spark.createDataFrame(rows, SAMPLES)


def trend(spark, series, seconds=1000):
    return L.lag_trend(samples(spark, series), seconds).first().trend


@pytest.mark.parametrize(
    "series,expected",
    [
        ([(1, 5)], "unknown"),
        ([(i, 0) for i in range(5)], "stable"),
        ([(i * 5, 100 + 50 * i) for i in range(6)], "growing"),
        ([(i * 5, 500 - 50 * i) for i in range(6)], "shrinking"),
        ([(i * 5, 1000 + i) for i in range(6)], "stable"),
    ],
)
def test_trend_classes(spark, series, expected):
    assert trend(spark, series) == expected


def test_instances_merge_by_second(spark):
    rows = [("g", 0, 10, 0, 100, 0), ("g", 1, 10, 1, 200, 1), ("g", 1, 10, 1, 250, 2)]
    got = L.lag_history(spark.createDataFrame(rows, SAMPLES)).first()
    assert got.partitions == {0: 100, 1: 250} and got.total == 350


def test_history_window(spark):
    df = samples(spark, [(0, 1), (700, 2), (1000, 3)])
    assert [r.ts for r in L.lag_history(df, 300).collect()] == [700, 1000]
    assert [r.ts for r in L.sample_retention(df, 300).collect()] == [1000]
    assert [r.ts for r in L.lag_history(df, 300, now=900).collect()] == [700, 1000]


def test_pivot_leaves_missing_partitions_null(spark):
    rows = [("g", 0, 10, 0, 4, 0), ("g", 1, 11, 1, 6, 1)]
    got = L.lag_history_pivot(spark.createDataFrame(rows, SAMPLES), [0, 1]).collect()
    assert [(r.p0, r.p1, r.total) for r in got] == [(4, None, 4), (None, 6, 6)]


def offsets(spark, committed, end):
    c = spark.createDataFrame([("t", p, o) for p, o in committed.items()],
                              "topic string, part long, committed long")
    e = spark.createDataFrame([("t", p, o) for p, o in end.items()],
                              "topic string, part long, end_offset long")
    return c, e


def test_consumer_lag(spark):
    c, e = offsets(spark, {0: 90, 1: 80, 2: 120, 3: -1}, {0: 100, 1: 100, 2: 100, 3: 100})
    got = {r.part: r.lag for r in L.consumer_lag(c, e, "t").collect()}
    assert got == {0: 10, 1: 20, 2: 0}
    assert L.consumer_lag(c, e, "other").count() == 0


def test_live_lag_keeps_unknown_partitions(spark):
    c, e = offsets(spark, {0: 90, 1: -1, 2: 5}, {0: 100, 1: 100})
    lags = L.live_lag(c, e)
    assert {r.part: r.lag for r in lags.collect()} == {0: 10, 1: None, 2: None}
    assert L.total_live_lag(lags).first().total_lag == 10


def test_partitions_at_end_without_revoked(spark):
    c, e = offsets(spark, {0: 100, 1: 50}, {0: 100, 1: 100})
    assert L.partitions_at_end(c, e).first().all_at_end is False
    assert L.partitions_at_end(c, e, revoked=c.filter("part = 1")).first().all_at_end is True


def test_internal_topics_are_left_out(spark):
    df = spark.createDataFrame(
        [("__offsets", 0, 5), ("x__assignor-1", 0, 5), ("events", 0, 5), ("events", 1, 7)],
        "topic string, part long, end_offset long",
    )
    assert [tuple(r) for r in L.topic_message_counts(df).collect()] == [("events", 12)]


INDICATORS = ("group_id string, instance long, ts long, fill_ratio double, poll_proximity double, "
              "idle_ms double, rebalance_count long, bottleneck_stage string")


def test_backpressure_takes_the_worst_of_the_latest(spark):
    rows = [
        ("g", 0, 1, 0.1, 0.99, 0.0, 9, "old"),
        ("g", 0, 5, 0.98, 0.4, 20.0, 1, "valkey"),
        ("g", 1, 4, 0.5, 0.75, 2.0, 2, "pg_events"),
        ("h", 0, 4, None, None, None, None, None),
    ]
    report = L.with_labels(L.backpressure_report(spark.createDataFrame(rows, INDICATORS)))
    got = {r.group_id: r for r in report.collect()}
    g, h = got["g"], got["h"]
    assert (g.fill_ratio, g.poll_proximity, g.idle_ms, g.rebalance_count) == (0.98, 0.75, 2.0, 3)
    assert (g.bottleneck_stage, g.instance_count, g.ts) == ("pg_events", 2, 5)
    assert (g.fill_status, g.proximity_status, g.idle_status) == (
        "saturated", "warning", "minimal headroom")
    assert (h.fill_ratio, h.idle_ms, h.rebalance_count) == (0.0, 0.0, 0)


def test_report_of_a_group_without_backpressure(spark):
    empty = spark.createDataFrame([], INDICATORS)
    got = L.lag_report(samples(spark, [(1, 5)]), empty).first()
    assert (got.consumer_lag, got.lag_trend, got.fill_ratio) == (5, "unknown", None)


def test_current_rate(spark):
    df = spark.createDataFrame(
        [("a", 0, 1), ("a", 100, 10), ("a", 130, 70), ("b", 130, 5)],
        "source string, ts long, count long",
    )
    got = {r.source: (r.current_rate, r.samples_count) for r in L.current_rate(df, 60).collect()}
    assert got == {"a": (2.0, 3), "b": (None, 1)}


def test_rebalances_older_than_the_window(spark):
    df = spark.createDataFrame(
        [("g", 0, t) for t in (1000, 1290, 1295, 1301)] + [("h", 0, 1300)],
        "group_id string, instance long, ts long")
    got = {r.group_id: (r.rebalance_count, r.unstable) for r in L.rebalance_stability(df).collect()}
    assert got == {"g": (3, True), "h": (1, False)}


def test_pivot_has_a_column_for_every_partition(spark):
    old, new = 1_000_000, 1_000_000 + 3 * 365 * 86_400
    rows = [("g", 0, old, 7, 5, 0), ("g", 0, new, 0, 9, 1)]
    samples = spark.createDataFrame(
        rows, "group_id string, instance long, ts long, part long, lag long, seq long")
    got = [tuple(r) for r in L.lag_history_pivot(samples, None, None).collect()]
    assert got == [("g", old, None, 5, 5), ("g", new, 9, None, 9)]


def test_unreadable_ramp_rows_are_left_out(spark):
    rows = [("r", 1, 10, 4, 1, "stable", 0), ("r", 1, 10, 9007199254740993, 2, None, 1),
            ("r", None, 10, 4, 3, "growing", 2), ("r", 1, 10, None, 4, "growing", 3)]
    steps = N.ramp_steps(spark.createDataFrame(
        rows, "run_id string, step long, rate_target long, consumer_throughput long, "
              "total_lag long, lag_trend string, seq long")).collect()
    assert [(s.step, s.avg_throughput, s.final_lag, s.samples) for s in steps] == [
        (1, (9007199254740993 + 4) // 2, 2, 2)]


BATCH = ("group_id string, instance long, batch_id long, end_ms long, batch_size long, "
         "max_batch_size long, pg_events_ms double, valkey_ms double, pg_sessions_ms double, "
         "poll_ms double, commit_ms double")


def batches(spark, stage_values, other=1.0):
    rows = [("g", 0, i, 1000 * (i + 1), 80, 100, v, other, other, 100.0, 50.0)
            for i, v in enumerate(stage_values)]
    return spark.createDataFrame(rows, BATCH)


@pytest.mark.parametrize(
    "values,slope", [([0, 2, 4, 6, 8], 2.0), ([10, 9, 8, 7, 6], -1.0), ([5], 0.0)]
)
def test_slopes(spark, values, slope):
    df = batches(spark, [float(v) for v in values])
    got = {r.stage: r.slope for r in B.stage_slopes(df).collect()}
    assert got["pg_events"] == pytest.approx(slope) and got["valkey"] == pytest.approx(0)
    last = B.stage_trend_rolling(df).orderBy("batch_id").collect()[-1]
    assert last.pg_events_slope == pytest.approx(slope)


def test_rising_stages(spark):
    rising = B.stage_trends(batches(spark, [3.0, 6.0, 9.0, 12.0])).collect()
    assert [(r.stage, r.first_ms, r.last_ms) for r in rising] == [("pg_events", 3.0, 12.0)]
    assert B.stage_trends(batches(spark, [0.0, 0.5, 1.0])).count() == 0
    assert B.bottleneck_stage(batches(spark, [3.0, 6.0])).first().bottleneck_stage == "pg_events"
    assert B.bottleneck_stage(batches(spark, [3.0, 3.0])).first().bottleneck_stage is None


def test_only_the_latest_hundred_batches_count(spark):
    values = [1000.0 - 9 * i for i in range(60)] + [float(i) for i in range(100)]
    got = {r.stage: r for r in B.stage_slopes(batches(spark, values)).collect()}["pg_events"]
    assert (got.slope, got.first_ms, got.last_ms) == (pytest.approx(1.0), 0.0, 99.0)


@pytest.mark.parametrize("block", [100, 130, 100_000])
def test_rolling_slopes_equal_a_plain_fit(spark, block):
    rng = random.Random(1)
    values = [rng.uniform(0, 50) for _ in range(350)]
    got = [r.pg_events_slope for r in B.stage_trend_rolling(
        batches(spark, values), block).orderBy("batch_id").collect()]

    def fit(ys):
        n, mx, my = len(ys), (len(ys) - 1) / 2, sum(ys) / len(ys)
        top = sum((i - mx) * (y - my) for i, y in enumerate(ys))
        return top / sum((i - mx) ** 2 for i in range(n)) if n > 1 else 0.0

    want = [fit(values[max(0, i - 99): i + 1]) for i in range(350)]
    assert got == pytest.approx(want, abs=1e-9)


def test_proximity(spark):
    rows = [("g", 0, 0, 0, 1, 1, 100.0, 60.0, 40.0, 100.0, 50.0),
            ("g", 0, 1, 0, 1, 1, 500.0, 150.0, 100.0, 100.0, 0.0),
            ("g", 0, 2, 0, 1, 1, 700.0, 150.0, 50.0, 50.0, 0.0)]
    got = B.poll_proximity(spark.createDataFrame(rows, BATCH), 1000).orderBy("batch_id").collect()
    assert [r.proximity for r in got] == pytest.approx([0.35, 0.85, 0.95])
    assert [r.severity for r in got] == ["healthy", "warning", "critical"]


def test_indicators_of_a_period(spark):
    rows = [("g", 0, 0, 1000, 80, 100, 1.0, 1.0, 1.0, 10.0, 7.0),
            ("g", 0, 1, 1030, 60, 100, 1.0, 1.0, 1.0, 10.0, 7.0)]
    marks = spark.createDataFrame(
        [("g", 0, 29), ("g", 0, 30), ("g", 0, -271), ("g", 1, 29), ("other", 0, 29)],
        "group_id string, instance long, ts long")
    got = B.batch_indicators(spark.createDataFrame(rows, BATCH), marks).first()
    assert got.fill_ratio == pytest.approx(0.7) and got.idle_ms == pytest.approx(5.0)
    assert (got.ts, got.rebalance_count, got.bottleneck_stage) == (30, 2, None)


def test_summary(spark):
    rows = [("g", 0, 0, 1000, 30, 100, 10.0, 20.0, 30.0, 10.0, 10.0),
            ("g", 0, 1, 1100, 30, 100, 10.0, 20.0, 30.0, 10.0, 10.0)]
    df = spark.createDataFrame(rows, BATCH)
    period = B.batch_summary(df).first()
    assert (period.batches, period.events, period.events_per_sec) == (2, 60, 2.0)
    assert period.avg_batch_ms == 60.0 and period.headroom == pytest.approx(100 * 10 / 30)
    lifetime = B.batch_summary(df, None).first()
    assert lifetime.events_per_sec == pytest.approx(60 / 0.18)


RAMP = ("run_id string, ts_ms long, step long, rate_target long, consumer_throughput long, "
        "total_lag long, lag_trend string, seq long")


def ramp(spark):
    rows, seq = [], 0
    plan = [(1, 1000, ["stable"] * 3), (2, 3000, ["growing", "stable", "stable"]),
            (3, 5000, ["growing", "growing", "stable"]), (4, 7000, ["growing", "unknown"])]
    for step, rate, trends in plan:
        for t in trends:
            rows.append(("new", 1000 + seq, step, rate, rate - seq, 10 * seq, t, seq))
            seq += 1
    rows.append(("old", 5, 1, 100, 7, 1, "growing", 100))
    rows.append(("old", 6, 1, 100, 8, 2, "stable", 101))
    return spark.createDataFrame(rows, RAMP)


def test_ramp_steps_and_saturation(spark):
    steps = {(r.run_id, r.step): r for r in N.ramp_steps(ramp(spark)).collect()}
    assert steps["new", 2].dominant_trend == "stable"
    assert steps["old", 1].dominant_trend == "growing"  # a tie goes to the first seen
    assert steps["old", 1].avg_throughput == 7 and steps["old", 1].final_lag == 2
    assert steps["new", 4].dominant_trend == "growing"
    got = {r.run_id: r for r in N.ramp_saturation(ramp(spark)).collect()}
    assert (got["new"].saturation_rate, got["new"].peak_sustainable_rate) == (5000, 3000)
    assert (got["old"].saturation_rate, got["old"].peak_sustainable_rate) == (100, None)


def test_runs(spark):
    assert [r.run_id for r in N.ramp_runs(ramp(spark)).collect()] == ["old", "new"]
    assert {r.run_id for r in N.ramp_latest_run(ramp(spark)).collect()} == {"new"}


POLL = "run_id string, ts_ms long, step long, count long, seq long"


def polls(spark, counts, step=1):
    return spark.createDataFrame(
        [("r", i, step, c, i) for i, c in enumerate(counts)], POLL)


@pytest.mark.parametrize("block", [1, 3, 100_000])
def test_throughput_between_samples(spark, block):
    rows = [("r", 0, 1, 100, 0), ("r", 1, 1, 150, 1), ("r", 2, 1, -1, 2), ("r", 3, 1, 157, 3),
            ("r", 4, 2, 200, 4), ("r", 5, 2, 190, 5)]
    got = N.sample_throughput(spark.createDataFrame(rows, POLL), block=block)
    assert [r.throughput for r in got.orderBy("seq").collect()] == [10, 0, 1, 0]


@pytest.mark.parametrize("block", [1, 4, 100_000])
def test_stalls(spark, block):
    counts = [0, 0, -1, 5, 5, -1, 5, 5, 9, 10]
    got = N.stall_detection(polls(spark, counts), 10, 3, block).orderBy("seq").collect()
    assert [r.unchanged_polls for r in got] == [1, 2, 2, 0, 1, 1, 2, 3, 0, 0]
    assert [r.percent for r in got] == [0, 0, 0, 50, 50, 50, 50, 50, 90, 100]
    assert [r.stalled for r in got] == [False] * 7 + [True, False, False]


def test_runs_by_environment(spark):
    df = spark.createDataFrame(
        [(0, "local", 10, 4, 7), (90_000, "local", 5, 2, 8), (5, "cloud", 1, 0, 3)],
        "ts_ms long, environment string, events_consumed long, duration_sec long, throughput long",
    )
    summary = {r.environment: r for r in N.bench_summary(df).collect()}["local"]
    assert (summary.runs, summary.min_throughput, summary.max_throughput,
            summary.avg_throughput) == (2, 7, 8, 7)
    rates = [r.events_per_sec for r in N.bench_throughput(df).collect()]
    assert rates == [2, 2, None]
    kept = N.bench_filter(df, "local", since_ms=1).collect()
    assert [str(r.started) for r in kept] == ["1970-01-01 00:01:00"]
