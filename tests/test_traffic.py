import json

import pytest

from pathwake.operators import sessions as S
from pathwake.operators import traffic as T
from pathwake.plans.overview import status_overview
from pathwake.schemas import STATE
from pyspark.sql import functions as F

DAY = 86_400_000
EVENT = "timestamp long, visitor_id long, event string, item_id long"


def sessions(spark, rows):
    """Rows of (start, carts, purchases)."""
    full = [(f"1_{i}", 1, i, start, start, c + p, 0, c, p, [], [], [], start)
            for i, (start, c, p) in enumerate(rows)]
    return spark.createDataFrame(full, STATE)


def funnel(spark, rows):
    return {r.time_window: r for r in T.funnel_metrics(sessions(spark, rows)).collect()}


def test_no_sessions_no_funnel(spark):
    assert funnel(spark, []) == {}
    assert T.funnel_json(sessions(spark, [])).count() == 0


def test_funnel_windows_are_open_at_the_lower_end(spark):
    newest = 100 * DAY
    got = funnel(spark, [(newest, 1, 2), (newest - DAY, 1, 0), (newest - DAY + 1, 0, 0),
                         (newest - 30 * DAY, 0, 1), (0, 0, 0)])
    assert {w: r.sessions for w, r in got.items()} == {
        "all_time": 5, "last_day": 2, "last_month": 3}
    assert got["all_time"].total_purchases == 3 and got["all_time"].purchase_sessions == 2
    assert got["last_day"].conversion_rate == 50.0
    assert got["last_day"].avg_items_per_purchase == 2.0


def test_purchase_without_cart_is_negative_abandonment(spark):
    got = funnel(spark, [(1, 1, 1), (2, 0, 1)])["all_time"]
    assert got.cart_abandonment == -100.0


def test_funnel_json(spark):
    text = T.funnel_json(sessions(spark, [(1, 1, 1)])).first().json
    assert json.loads(text)["last_day"]["conversion_rate"] == 100.0


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        (1, 1, "view", 10), (2, 1, "view", 10), (3, 1, "addtocart", 10), (4, 2, "view", 11),
        (DAY + 3_600_000, 2, "transaction", 11), (DAY + 3_600_001, 3, "view", 10),
    ]
    return spark.createDataFrame(rows, EVENT)


def test_daily_funnel(events):
    got = [(r.unique_visitors, r.viewers, r.carters, r.purchasers)
           for r in T.conversion_funnel(events).collect()]
    assert got == [(2, 2, 1, 0), (2, 1, 0, 1)]


def test_hours(events):
    assert [tuple(r) for r in T.hourly_traffic(events).collect()] == [(0, 4, 2), (1, 2, 2)]


def test_items_and_visitors(events):
    item = {r.item_id: r for r in T.item_metrics(events).collect()}[10]
    assert (item.view_count, item.cart_count, item.unique_visitors) == (3, 1, 2)
    visitors = {r.visitor_id: r for r in
                T.visitor_metrics(events, S.sessionize(events)).collect()}
    assert (visitors[1].total_sessions, visitors[1].total_views,
            visitors[1].unique_items_viewed) == (1, 2, 1)
    assert visitors[2].total_sessions == 2 and visitors[2].total_purchases == 1


def test_top_lists(events):
    assert [tuple(r) for r in T.top_viewed_items(events).collect()] == [(10, 3), (11, 1)]
    assert [tuple(r) for r in T.top_purchased_items(events, 1).collect()] == [(11, 1)]
    assert T.event_type_breakdown(events, 1).first().event == "view"


def test_buckets(events):
    got = T.events_over_time(events, "1 day", "1970-01-01", "1970-01-02 01:00:00").collect()
    assert sorted(r.events for r in got) == [1, 4]
    assert T.auto_interval(0, 49_000) == "1 seconds"
    assert T.auto_interval(0, 30 * DAY) == "86400 seconds"


def test_overview(spark, events):
    made = S.sessionize(events)
    end = spark.createDataFrame([("t", 0, 4)], "topic string, part long, end_offset long")
    counters = spark.createDataFrame([("s", 0, 1), ("s", 10, 6)], "source string, ts long, count long")
    got = {r.metric: r.value for r in status_overview(
        {"events": events}, end, S.latest_state(made), F.lit(DAY + 4_000_000), counters).collect()}
    assert got == {"table events": 6, "topic t": 4, "active sessions": 2, "rate s": 0.5}
