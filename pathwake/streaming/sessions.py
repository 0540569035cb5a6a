"""Sessions on a stream, with the same results as the batch operator.

Micro-batches are combined per task before they are shuffled: events of a visitor within one
slot of ``timeout + 1`` ms belong to one session, so they fold into one row per item. What a
task sends over for a visitor is then bounded by slots and items instead of events.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, StructField, StructType

from pathwake.functions.columns import event_time
from pathwake.operators.sessions import TYPED
from pathwake.schemas import SESSION_TIMEOUT_MS, STATE

# A visitor's combined events of one task, as parallel lists.
COMBINED = (
    "visitor_id bigint, slot array<bigint>, first_ts array<bigint>, first_seq array<bigint>, "
    "item_id array<bigint>, event array<string>, n array<bigint>, last_ts array<bigint>"
)
_LISTS = ["slot", "first_ts", "first_seq", "item_id", "event", "n", "last_ts"]
_KEYS = ["visitor_id", "slot", "event", "item_id"]
_PARTS = [*_KEYS, "n", "first_ts", "last_ts", "first_seq"]
MERGE_ROWS = 25_000  # rows gathered before they are combined anew
HELD_ROWS = 50_000  # combined rows a task holds before it sends them; a task takes some 120 MB for them
_NAMES = STATE.names
_OUTPUT = Row(*_NAMES)
_VISITOR, _NUMBER, _COUNT, _LAST = map(_NAMES.index, ("visitor_id", "session_num", "event_count", "last_activity"))
# State calls cost milliseconds a key and micro-batch, so a key is a place of 16 neighbouring visitor
# ids. A place is rewritten as a whole; ``changed`` marks the sessions its last update was for.
PLACE_BITS = 4
PLACE = StructType().add("sessions", ArrayType(StructType([*STATE.fields, StructField("changed", BooleanType())])))

# Ship the functions of this module with the query: workers then need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per visitor with its events of the task combined by slot, type and item.

    ``first_seq`` belongs to the event of ``first_ts``. Results are gathered over the batches of
    the task; only one that holds ``HELD_ROWS`` combined rows sends them and starts anew, so a
    visitor may then come again.
    """
    parts, rows, limit = [], 0, MERGE_ROWS
    for batch in batches:
        read = pa.Table.from_batches([batch])
        one = pa.repeat(pa.scalar(1, pa.int64()), read.num_rows)
        ts, seq = read["timestamp"], read["seq"]
        single = pa.Table.from_arrays([*[read[k] for k in _KEYS], one, ts, ts, seq], _PARTS)
        parts.append(_combined(single))
        rows += parts[-1].num_rows
        if rows >= limit:
            parts = [_combined(pa.concat_tables(parts))]
            rows = parts[0].num_rows
            if rows >= HELD_ROWS:
                yield from _by_visitor(parts[0])
                parts, rows = [], 0
            limit = max(MERGE_ROWS, 2 * rows)
    if parts:
        yield from _by_visitor(_combined(pa.concat_tables(parts)))


def _combined(parts: pa.Table) -> pa.Table:
    ordered = parts.sort_by([("first_ts", "ascending"), ("first_seq", "ascending")])
    return ordered.group_by(_KEYS, use_threads=False).aggregate(
        [("n", "sum"), ("first_ts", "first"), ("last_ts", "max"), ("first_seq", "first")]
    ).rename_columns(_PARTS)


def _by_visitor(parts: pa.Table) -> list[pa.RecordBatch]:
    lists = parts.group_by("visitor_id", use_threads=False).aggregate(
        [(name, "list") for name in _LISTS]
    )
    return lists.rename_columns(["visitor_id", *_LISTS]).to_batches()


class SessionFold(StatefulProcessor):
    """Keeps the current sessions of a place's visitors and emits every session a micro-batch touches.

    With timers (``ttl_ms``) an idle session's content is dropped after its time to live; its
    number stays, so that a returning visitor's session ids never repeat. A place has one timer,
    for the first of its sessions to run out.
    """

    def __init__(self, timeout_ms: int, ttl_ms: int | None):
        self.timeout_ms = timeout_ms
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getValueState("sessions", PLACE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        parts: dict[int, list] = {}
        for row in rows:
            parts.setdefault(row["visitor_id"], []).append(zip(*(row[name] for name in _LISTS)))
        sessions, touched = self._load(), []
        for visitor, found in parts.items():
            touched += self._fold(visitor, sessions.get(visitor), chain.from_iterable(found))
            sessions[visitor] = _values(touched[-1])
        self._save(sessions, parts)
        for session in touched:
            yield _OUTPUT(*_values(session))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        sessions, cleared = self._load(), set()
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        for visitor, session in sessions.items():
            if session[_COUNT] and session[_LAST] + self.ttl_ms <= passed:
                sessions[visitor] = _values(_blank(visitor, session[_NUMBER], 0))
                cleared.add(visitor)
        self._save(sessions, cleared)
        yield from ()

    def close(self) -> None:
        pass

    def _fold(self, visitor: int, stored: tuple | None, parts: Iterator[tuple]) -> list[dict]:
        """The sessions that the combined rows of a visitor touch; the last one is the current one."""
        current = _opened(stored)
        touched, slot = [], None
        for part in sorted(parts, key=_in_order):
            part_slot, first_ts, _, item, kind, n, last_ts = part
            if part_slot != slot:
                slot = part_slot
                if self._expired(current, first_ts):
                    number = current["session_num"] + 1 if current else 1
                    current = _blank(visitor, number, first_ts)
                if not touched or touched[-1] is not current:
                    touched.append(current)
                current["last_activity"] = last_ts
            _add(current, kind, item, n, last_ts)
        return touched

    def _load(self) -> dict[int, tuple]:
        stored = self.sessions.get()
        return {s[_VISITOR]: tuple(s)[: len(_NAMES)] for s in stored[0]} if stored else {}

    def _save(self, sessions: dict[int, tuple], changed) -> None:
        self.sessions.update(([(*values, visitor in changed) for visitor, values in sessions.items()],))
        if self.ttl_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            due = [s[_LAST] + self.ttl_ms for s in sessions.values() if s[_COUNT]]
            if due:
                self.handle.registerTimer(min(due))

    def _expired(self, current: dict | None, first_ts: int) -> bool:
        if current is None or current["last_activity"] == 0:
            return True
        return first_ts - current["last_activity"] > self.timeout_ms


def _in_order(part: tuple):
    slot, first_ts, first_seq, item, *_ = part
    return slot, first_ts, first_seq, item is not None, item or 0


def _blank(visitor: int, number: int, start: int) -> dict:
    """A session without events; item lists are ordered sets (dicts) while being folded."""
    values = dict.fromkeys(_NAMES, 0) | {items: {} for _, items in TYPED.values()}
    return values | {
        "session_id": f"{visitor}_{number}",
        "visitor_id": visitor,
        "session_num": number,
        "session_start": start,
        "session_end": start,
        "last_activity": start,
    }


def _add(current: dict, kind: str, item: int | None, n: int, last_ts: int) -> None:
    current["event_count"] += n
    current["last_activity"] = max(current["last_activity"], last_ts)
    current["session_end"] = max(current["session_end"], last_ts)
    if kind in TYPED:
        counter, items = TYPED[kind]
        current[counter] += n
        current[items].setdefault(item)


def _opened(stored: tuple | None) -> dict | None:
    if stored is None:
        return None
    current = dict(zip(_NAMES, stored))
    return current | {items: dict.fromkeys(current[items]) for _, items in TYPED.values()}


def _values(session: dict) -> tuple:
    closed = session | {items: list(session[items]) for _, items in TYPED.values()}
    return tuple(closed[name] for name in _NAMES)


def stream_sessions(
    events: DataFrame,
    timeout_ms: int = SESSION_TIMEOUT_MS,
    ttl_ms: int | None = None,
    late_after: str = "1 day",
) -> DataFrame:
    """Changed sessions per micro-batch in the state layout; a session comes once per change.

    Late events are accepted at any age and state is kept for good. With ``ttl_ms`` (such as
    ``STATE_TTL_MS``) state is cleared when event time, ``late_after`` behind the newest event,
    passes the last activity by so much. No event is dropped: a late one joins the session in
    the state, or opens the next if that was cleared.
    """
    seq = F.col("seq") if "seq" in events.columns else F.lit(0).cast("bigint")
    slot = F.floor(F.col("timestamp") / (timeout_ms + 1)).cast("bigint")
    rows = events.select(
        "visitor_id", slot.alias("slot"), "event", "item_id", "timestamp", seq.alias("seq")
    )
    combined = rows.mapInArrow(combine, COMBINED)
    if ttl_ms is not None:
        # The watermark drops rows of an older time, so those with events have none. The time
        # comes in a second row of the visitor, without events.
        timeless = F.struct(*_LISTS, F.lit(None).cast("timestamp").alias("event_time"))
        empty = [F.array().cast(combined.schema[name].dataType).alias(name) for name in _LISTS]
        time = F.struct(*empty, event_time(F.array_max("last_ts")).alias("event_time"))
        rows = combined.select("visitor_id", F.inline(F.array(timeless, time)))
        combined = rows.withWatermark("event_time", late_after)
    place = F.shiftright("visitor_id", PLACE_BITS)
    return combined.withColumn("place", place).groupBy("place").transformWithState(
        SessionFold(timeout_ms, ttl_ms),
        outputStructType=STATE,
        outputMode="Update",
        timeMode="None" if ttl_ms is None else "EventTime",
    )


def stored_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Current session of every visitor, read from the checkpoint of a session stream."""
    store = spark.read.format("statestore").option("stateVarName", "sessions").load(checkpoint)
    return store.select(F.inline("value.sessions")).select(*_NAMES)


def state_changes(spark: SparkSession, checkpoint: str, first_batch: int = 0) -> DataFrame:
    """``(batch_id, change_type, visitor_id)`` and the session, for every change of state since a batch."""
    store = (
        spark.read.format("statestore").option("stateVarName", "sessions")
        .option("readChangeFeed", True).option("changeStartBatchId", first_batch).load(checkpoint)
    )
    changes = store.select("batch_id", "change_type", F.inline("value.sessions")).filter("changed")
    return changes.select("batch_id", "change_type", "visitor_id", F.struct(*_NAMES).alias("session"))


def stream_closed_sessions(
    events: DataFrame, timeout_ms: int = SESSION_TIMEOUT_MS, late_after: str = "1 day"
) -> DataFrame:
    """Each session once, when it can no longer change: an append-only stream.

    A session is closed when event time, ``late_after`` behind the newest event, has passed its
    last event by the timeout. Sessions have no numbers here and hold their items as
    sorted sets. Spark drops rows whose session would be closed already; its progress reports
    count them. :func:`stream_sessions` keeps them.
    """
    timed = events.withColumn("event_time", event_time(F.col("timestamp"))).withWatermark("event_time", late_after)
    # Windows that touch are one, so an equal gap stays in the session.
    window = F.session_window("event_time", f"{timeout_ms} milliseconds")
    typed = []
    for kind, (counter, items) in TYPED.items():
        typed += [
            F.count_if(F.col("event") == kind).alias(counter),
            F.array_sort(F.collect_set(F.when(F.col("event") == kind, F.col("item_id")))).alias(items),
        ]
    closed = timed.groupBy("visitor_id", window.alias("window")).agg(
        F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end"),
        F.count("*").alias("event_count"), *typed,
    )
    return closed.drop("window")
