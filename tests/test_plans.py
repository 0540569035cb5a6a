"""Shapes of physical plans that have to hold at any table size."""

import pytest

import __spark_entry__ as entry_points
from pathwake.operators import batches, sessions, skew, traffic
from pathwake.runtime import stored
from pathwake.sources import adapters

DIRECTORY = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clicks(spark):
    return adapters.clicks(spark, DIRECTORY)


def test_ordinary_sessions_shuffle_once(clicks):
    text = plan(sessions.sessionize(clicks))
    assert text.count("Exchange hashpartitioning(visitor_id") == text.count("Exchange ") == 1


def test_heavy_visitors_are_combined_before_the_shuffle(clicks):
    text = plan(sessions.sessionize(clicks, heavy_rows=1))
    heavy = text[text.index("partial_min(struct"):]
    below = heavy[:heavy.index("FileScan")]
    assert "Exchange hashpartitioning" not in below  # only the list of heavy keys is sent


def test_heavy_visitors_are_counted_before_duplicates_go(clicks, monkeypatch):
    counted = []
    monkeypatch.setattr(skew, "stored", lambda df, label: counted.append(plan(df)) or stored(df, label))
    sessions.sessionize(clicks, dedupe=True, heavy_rows=1)
    assert len(counted) == 1 and counted[0].count("Exchange ") == 1


def test_filters_and_columns_reach_the_scan(clicks):
    text = plan(traffic.top_viewed_items(clicks))
    assert "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<event_type:string,props:string>" in text
    assert "PushedFilters: [In(event_type" in text


def test_time_range_reaches_the_scan(spark, tmp_path):
    spark.range(5).selectExpr("id AS timestamp").write.parquet(f"{tmp_path}/events")
    stored = spark.read.parquet(f"{tmp_path}/events")
    text = plan(traffic.events_over_time(stored, "1 day", "2024-01-05", "2024-01-06"))
    assert "GreaterThanOrEqual(timestamp,1704412800000)" in text


def test_daily_funnel_does_not_expand_rows(clicks):
    assert "Expand" not in plan(traffic.conversion_funnel(clicks))


def test_latest_batches_are_limited_map_side(spark):
    text = plan(batches.stage_slopes(adapters.batch_metrics(spark, DIRECTORY)))
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "name", sorted(n for n in QUERIES if not n.startswith("stream") and n != "run_available")
)
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, DIRECTORY))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
