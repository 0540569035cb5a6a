"""Release times for publishing stored events: at replay speed or at a fixed rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwake.operators.ordering import with_position

ORDER = ["timestamp", "seq"]
PAGE_ROWS = 1_000_000  # rows up to the end of a page that one task may keep sorted


def _require_positive(what: str, value: float) -> None:
    if not value > 0:
        raise ValueError(f"a {what} above zero is needed: {value!r}")


def replay_schedule(events: DataFrame, speed: float = 1.0) -> DataFrame:
    """Seconds after the first event at which each is released at ``speed`` times real time.

    In time order the waits between events add up to the distance from the first one, so no
    row needs its neighbour.
    """
    _require_positive("replay speed", speed)
    first = events.select(F.min("timestamp").alias("first")).scalar()
    offset = (F.col("timestamp") - first) / F.lit(1000.0 * speed)
    return events.withColumn("release_sec", offset)


def default_burst(rate: float) -> int:
    return max(int(rate * 0.1), 100)


def rate_limited_schedule(
    events: DataFrame, rate: float, burst: int | None = None
) -> DataFrame:
    """Seconds at which each event is released by a token bucket that starts full.

    The source is always ready, so the bucket never refills beyond what is taken: event ``i``
    (from 0, in time order) goes out once ``i + 1 - burst`` tokens have come in.
    """
    _require_positive("release rate", rate)
    burst = default_burst(rate) if burst is None else burst
    positioned = with_position(events, [], ORDER)
    wait = (F.col("position") + F.lit(1 - burst)) / F.lit(float(rate))
    return positioned.withColumn("release_sec", F.greatest(F.lit(0.0), wait))


def slice_events(
    events: DataFrame, offset: int = 0, limit: int = 0, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Events from ``offset`` on in time order, at most ``limit`` of them (0: all).

    A page that ends within the first ``page_rows`` rows keeps the smallest rows of each task
    and merges those. A later one, and an offset alone, select by position, so that the skipped
    rows are not gathered anywhere.
    """
    if limit and offset + limit <= page_rows:
        return events.orderBy(*ORDER).offset(offset).limit(limit)
    if not offset and not limit:
        return events
    positioned = with_position(events, [], ORDER)
    kept = F.col("position") >= offset
    if limit:
        kept = kept & (F.col("position") < offset + limit)
    return positioned.filter(kept).drop("position")
