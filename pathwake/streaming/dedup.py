"""First rows of a stream: duplicates are removed by keyed state, late rows set apart.

State lies in places, of five minutes of event time and a hash of the event key, that hold the
keys seen there. It is cleared by an event-time timer once the watermark has passed the hour. A
row of such an hour can no longer be judged. It is neither dropped nor taken for new but marked as
late, for a sink of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR_MS = 3_600_000
# Copies of an event have its time and so its place. A place costs a few milliseconds of state calls
# a micro-batch, so it takes the rows of many visitors; new rows read the keys of theirs alone.
SLOT_MS = 300_000
PLACES = 16
_EVENT = ["timestamp", "visitor_id", "event", "item_id", "transaction_id", "seq"]
_LAYOUT = (
    "timestamp bigint, visitor_id bigint, event string, item_id bigint, transaction_id bigint, seq bigint"
)
_KEY = ["visitor_id", "timestamp", "event", "item_id"]
_SEEN = "visitor_id array<bigint>, timestamp array<bigint>, event array<string>, item_id array<bigint>"
_OUTPUT = Row(*_EVENT, "late")

# Ship the functions of this module with the query: workers then need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _with_time(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without event time, and one row a task with its newest.

    The watermark drops rows of an older time; rows that have none stay, and the last row alone
    moves it on.
    """
    newest, schema = None, None
    for batch in batches:
        schema = batch.schema
        last = pc.max(batch.column("timestamp")).as_py()
        newest = last if newest is None else max(newest, newest if last is None else last)
        none = pa.nulls(batch.num_rows, pa.timestamp("us", "UTC"))
        yield pa.RecordBatch.from_arrays([*batch.columns, none], names=[*schema.names, "event_time"])
    if newest is not None:
        empty = [pa.nulls(1, f.type) for f in schema]
        time = pa.array([newest * 1000], pa.timestamp("us", "UTC"))
        yield pa.RecordBatch.from_arrays([*empty, time], names=[*schema.names, "event_time"])


class FirstRows(StatefulProcessor):
    """Emits the first row per key in arrival order, and every row that comes too late."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", _SEEN)  # the new keys of each micro-batch

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        slot, _ = key
        if slot is None:  # the rows that carry the time
            return
        end = (slot * SLOT_MS // HOUR_MS + 1) * HOUR_MS
        if end <= timerValues.getCurrentWatermarkInMs():
            for row in rows:
                yield _OUTPUT(*[row[name] for name in _EVENT], True)
            return
        first: dict[tuple, Row] = {}
        for row in rows:
            event_key = tuple(row[name] for name in _KEY)
            if event_key not in first or row["seq"] < first[event_key]["seq"]:
                first[event_key] = row
        stored = False
        for keys in self.seen.get():
            stored = True
            for event_key in zip(*keys):
                first.pop(event_key, None)
        if not first:
            return
        self.seen.appendValue(tuple(list(column) for column in zip(*first)))
        if not stored:
            self.handle.registerTimer(end)
        for row in first.values():
            yield _OUTPUT(*[row[name] for name in _EVENT], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_dedup(events: DataFrame, late_after: str = "1 day") -> DataFrame:
    """First row per event key by ``seq``, with ``late``; late rows come with all their copies.

    A key is remembered for its hour of event time and ``late_after`` more. A row is late if its
    hour ended that long before the newest event of earlier batches. Rows without a visitor or
    time are left out.
    """
    rows = events.filter("visitor_id is not null and timestamp is not null").select(*_EVENT)
    timed = rows.mapInArrow(_with_time, f"{_LAYOUT}, event_time timestamp").withWatermark("event_time", late_after)
    slot = F.floor(F.col("timestamp") / SLOT_MS).cast("bigint")
    place = F.pmod(F.xxhash64(*_KEY), F.lit(PLACES)).cast("int")
    return (
        timed.withColumns({"slot": slot, "place": place})
        .groupBy("slot", "place")
        .transformWithState(
            FirstRows(), outputStructType=f"{_LAYOUT}, late boolean", outputMode="Append", timeMode="EventTime"
        )
    )


def split_late(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first rows of a micro-batch, and its late rows."""
    return batch.filter(~F.col("late")).drop("late"), batch.filter("late").drop("late")
