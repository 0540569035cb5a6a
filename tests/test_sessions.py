import pytest
from pyspark.sql import functions as F

from pathwake.operators import sessions as S
from pathwake.schemas import STATE
from tests.fold import fold, random_events

COLUMNS = "timestamp long, visitor_id long, event string, item_id long, seq long"
MINUTES_30 = 1_800_000


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def by_id(df):
    return {r.session_id: r.asDict() for r in df.collect()}


def views(*times, visitor=7):
    return [(t, visitor, "view", 1, i) for i, t in enumerate(times)]


def test_gap_equal_to_timeout_stays(spark):
    got = by_id(S.sessionize(frame(spark, views(0, MINUTES_30))))
    assert list(got) == ["7_1"] and got["7_1"]["event_count"] == 2


def test_gap_above_timeout_opens_a_session(spark):
    assert set(by_id(S.sessionize(frame(spark, views(0, MINUTES_30 + 1))))) == {"7_1", "7_2"}


def test_both_sessions_of_one_batch_are_returned(spark):
    assert set(by_id(S.sessionize(frame(spark, views(0, 7_200_000))))) == {"7_1", "7_2"}


def test_items_in_first_seen_order(spark):
    rows = [(1, 7, "view", 30, 0), (2, 7, "view", 7, 1), (3, 7, "view", 30, 2)]
    session = by_id(S.sessionize(frame(spark, rows)))["7_1"]
    assert session["items_viewed"] == [30, 7] and session["view_count"] == 3
    sets = S.session_item_sets(S.sessionize(frame(spark, rows))).first()
    assert sets.items_viewed == [7, 30]


def test_unknown_type_counts_as_event_only(spark):
    session = by_id(S.sessionize(frame(spark, [(5, 7, "signup", 1, 0)])))["7_1"]
    assert session["event_count"] == 1
    assert session["view_count"] == session["cart_count"] == session["transaction_count"] == 0


def test_duplicates_count_unless_removed(spark):
    rows = spark.createDataFrame(
        [(1, 7, "view", 3, 0, None), (1, 7, "view", 3, 1, None)],
        COLUMNS + ", transaction_id long",
    )
    assert by_id(S.sessionize(rows))["7_1"]["event_count"] == 2
    assert by_id(S.sessionize(rows, dedupe=True))["7_1"]["event_count"] == 1


def test_table_record(spark):
    rows = [(1000, 7, "view", 1, 0), (3999, 7, "transaction", 2, 1)]
    record = S.to_table(S.sessionize(frame(spark, rows))).first()
    assert record.duration_seconds == 2 and record.converted is True


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("heavy_rows", [1, 60, 10**9])
def test_equals_plain_fold(spark, seed, heavy_rows):
    rows = random_events(seed)
    want, _ = fold(rows, 1000)
    got = by_id(S.sessionize(frame(spark, rows), 1000, heavy_rows=heavy_rows))
    assert got == want


def test_large_visitor_spreads_over_time_slots(spark):
    """The window of a heavy visitor sees time slots, not events."""
    rows = spark.range(20_000).selectExpr(
        "id % 500 AS timestamp", "1L AS visitor_id", "'view' AS event", "id % 9 AS item_id",
        "id AS seq",
    )
    session = by_id(S.sessionize(rows, 1000, heavy_rows=100))["1_1"]
    assert session["event_count"] == 20_000 and sorted(session["items_viewed"]) == list(range(9))


@pytest.mark.parametrize("seed", range(4))
def test_resume_equals_fold_over_two_batches(spark, seed):
    rows = sorted(random_events(seed), key=lambda e: (e[0], e[4]))
    first, second = rows[:140], rows[140:]
    _, state = fold(first, 1000)
    stored = S.latest_state(S.sessionize(frame(spark, first), 1000))
    text = S.state_to_text(stored)
    assert {f.dataType.simpleString() for f in text.schema} == {"string"}
    got = by_id(S.resume_sessions(frame(spark, second), S.state_from_text(text), 1000))
    want, _ = fold(second, 1000, {v: _copy(s) for v, s in state.items()})
    assert got == want


def _copy(session):
    return {k: list(v) if isinstance(v, list) else v for k, v in session.items()}


def test_late_event_continues_the_stored_session(spark):
    state = S.latest_state(S.sessionize(frame(spark, views(1000, 2000))))
    got = by_id(S.resume_sessions(frame(spark, views(1500)), state))["7_1"]
    assert (got["session_start"], got["session_end"], got["last_activity"]) == (1000, 2000, 1500)


def test_cleared_state_keeps_numbering(spark):
    cleared = spark.createDataFrame([("7_3", 7, 3, 0, 0, 0, 0, 0, 0, [], [], [], 0)], STATE)
    assert set(by_id(S.resume_sessions(frame(spark, views(50)), cleared))) == {"7_4"}


def test_active_sessions(spark):
    state = S.latest_state(S.sessionize(frame(spark, views(1, visitor=1) + views(90, visitor=2))))
    assert S.active_sessions(state, F.lit(100), 50).first()[0] == 1


def test_unknown_visitor_may_be_the_largest(spark):
    rows = spark.range(300).selectExpr(
        "id AS timestamp", "IF(id < 200, NULL, id % 3) AS visitor_id", "'view' AS event",
        "id % 4 AS item_id", "id AS seq",
    )
    got = S.sessionize(rows, 1000, heavy_rows=100)
    want = S.sessionize(rows, 1000)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
