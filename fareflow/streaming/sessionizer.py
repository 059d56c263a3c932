"""The stateful sessionizer: ride slots kept across micro-batches, emitted when a ride closes.

A call between Python and the state store costs about a millisecond, whatever it carries. So the state is keyed by buckets of
rides, and a micro-batch reads and writes the rides of a bucket together. What fills a slot passes through as one JSON text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fareflow.operators.sessions import SLOT_FIELDS, derive_session
from fareflow.schemas import (
    EVENT_ORDINALS,
    RIDE_EVENT,
    RIDE_SESSION,
    SESSION_TIMEOUT_SEC,
    TERMINAL_TYPES,
)

BUCKETS = 4096
_SLOT_VALUES = T.StructType(
    [
        T.StructField(n, T.LongType() if n == "event_ts" else RIDE_EVENT[n].dataType)
        for n in SLOT_FIELDS
    ]
)
_SLOT_NAMES = [f"s{n}" for n in EVENT_ORDINALS.values()]
_TERMINAL = [EVENT_ORDINALS[t] - 1 for t in TERMINAL_TYPES]
_OPEN_SLOTS = [i for i in range(len(_SLOT_NAMES)) if i not in _TERMINAL]
#: An open ride: when a timer looks at it, and of each slot the arrival, time and values. Terminal slots never stay open.
_OPEN = T.StructType(
    [
        T.StructField("ride_id", T.StringType()),
        T.StructField("wake", T.LongType()),
        *[
            T.StructField(f"{part}{i + 1}", kind)
            for i in _OPEN_SLOTS
            for part, kind in (("at", T.LongType()), ("ms", T.LongType()), ("s", T.StringType()))
        ],
    ]
)
_CLOSED = T.StructType([T.StructField("ride_id", T.StringType()), T.StructField("closed_at", T.LongType())])
OUTPUT = T.StructType(
    [
        T.StructField("ride_id", T.StringType()),
        *[T.StructField(s, T.StringType()) for s in _SLOT_NAMES],
        *[T.StructField(f"first_{name}", T.LongType()) for name in TERMINAL_TYPES],
    ]
)
_READ = ["ride_id", "event_seq", "arrival", "event_ms", "slot"]
#: Stands for an unknown offset or time, so that columns stay whole numbers: any known one is later.
UNKNOWN = -(2**63)
NEVER = 2**63 - 1


class RideSlots(StatefulProcessor):
    """At most one slot per lifecycle ordinal is kept for a ride, however many events it has.

    The key is a bucket of rides. Its open rides are one list, read and written once per micro-batch that has rows of the bucket;
    a closed ride leaves a mark in a second list for ever, so that it never opens again. Marks are only added to; a micro-batch
    reads those of the buckets it has rows of.
    """

    def __init__(self, timeout_ms: int, delay_ms: int) -> None:
        self.timeout_ms = timeout_ms
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _OPEN)
        self.closed = handle.getListState("closed", _CLOSED)

    def close(self) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        done = {mark[0] for mark in self.closed.get()}
        rides, wakes = self._stored()
        woken = min(wakes.values(), default=NEVER)
        touched = {}
        for frame in rows:
            for ride, seq, at, ms, slot in frame[_READ].itertuples(index=False, name=None):
                if ride in done:
                    continue  # closed is final
                slots = touched.get(ride)
                if slots is None:
                    slots = touched[ride] = rides.setdefault(ride, [None] * len(_SLOT_NAMES))
                old = slots[seq - 1]
                if old is None:
                    slots[seq - 1] = (at, at, ms, slot)
                elif at > old[1]:
                    slots[seq - 1] = (self._first(old[0], at), at, ms, slot)
                elif at < old[0]:
                    slots[seq - 1] = (self._first(old[0], at), *old[1:])
        ended = [ride for ride, slots in touched.items() if any(slots[i] is not None for i in _TERMINAL)]
        closing = {ride: rides.pop(ride) for ride in ended}
        for ride in touched:
            if ride in rides and ride not in wakes:
                wakes[ride] = self._wake(rides[ride], timerValues)
        if touched:
            self._store(rides, wakes)
            # A timer stands at or before the earliest of the rides that were open before.
            earliest = min((wakes[ride] for ride in rides), default=NEVER)
            if earliest < woken:
                self.handle.registerTimer(earliest)
        yield from self._closed(closing)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        rides, wakes = self._stored()
        due = [ride for ride in rides if wakes[ride] <= now]
        closing = {ride: rides.pop(ride) for ride in due if self._expiry(rides[ride]) <= now}
        for ride in due:
            if ride in rides:
                wakes[ride] = self._wake(rides[ride], timerValues)
        if due:
            self._store(rides, wakes)
        earliest = min((wakes[ride] for ride in rides), default=NEVER)
        if earliest < NEVER:
            self.handle.registerTimer(earliest)
        yield from self._closed(closing)

    def _stored(self) -> tuple[dict, dict]:
        """Slots of the bucket's open rides, and when a timer looks at them."""
        rides, wakes = {}, {}
        for ride, wake, *values in self.open.get():
            slots = [None] * len(_SLOT_NAMES)
            for n, i in enumerate(_OPEN_SLOTS):
                at, ms, slot = values[3 * n : 3 * n + 3]
                if slot is not None:
                    slots[i] = (at, at, ms, slot)
            rides[ride], wakes[ride] = slots, wake
        return rides, wakes

    def _store(self, rides: dict, wakes: dict) -> None:
        rows = [
            (ride, wakes[ride], *[v for i in _OPEN_SLOTS for v in ((None,) * 3 if slots[i] is None else slots[i][1:])])
            for ride, slots in rides.items()
        ]
        if rows:
            self.open.put(rows)
        else:
            self.open.clear()

    @staticmethod
    def _first(a: int, b: int) -> int:
        """The earlier of two arrivals; a known one before an unknown."""
        return max(a, b) if UNKNOWN in (a, b) else min(a, b)

    @staticmethod
    def _newest(slots: list) -> int:
        return max(s[2] for s in slots if s is not None)

    def _expiry(self, slots: list) -> int:
        """Watermark at which the ride is overdue: it trails the newest event by the delay."""
        newest = self._newest(slots)
        return NEVER if newest == UNKNOWN else newest + self.timeout_ms - self.delay_ms + 1

    def _wake(self, slots: list, timerValues: Any) -> int:
        return max(self._expiry(slots), timerValues.getCurrentWatermarkInMs() + 1)

    def _closed(self, rides: dict) -> Iterator[pd.DataFrame]:
        """Mark the rides as closed and give them out."""
        if not rides:
            return
        self.closed.appendList([(ride, self._newest(slots)) for ride, slots in rides.items()])
        rows = [
            (
                ride,
                *[None if s is None else s[3] for s in slots],
                *[None if slots[i] is None or slots[i][0] == UNKNOWN else slots[i][0] for i in _TERMINAL],
            )
            for ride, slots in rides.items()
        ]
        yield pd.DataFrame(rows, columns=OUTPUT.names, dtype=object)


def sessionize(
    events: DataFrame,
    timeout_sec: int = SESSION_TIMEOUT_SEC,
    delay_sec: int = SESSION_TIMEOUT_SEC,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Stream of closed sessions from a stream of clean ride events.

    A ride closes with the micro-batch that brings its terminal event, or once the newest event
    time is strictly more than ``timeout_sec`` past its last one. The watermark delay only says which
    rows Spark drops before they reach the state, since timers allow for it: with the timeout as
    delay, a dropped row is one that could not have kept its ride open. Needs the RocksDB store. A checkpoint keeps its
    number of ``buckets``.
    """
    known = F.create_map(*[F.lit(x) for pair in EVENT_ORDINALS.items() for x in pair])
    rows = (
        events.withWatermark("event_ts", f"{delay_sec} seconds")
        .withColumn("event_seq", F.try_element_at(known, F.col("event_type")))
        .where(F.col("event_seq").isNotNull())
        .withColumn("event_ms", F.unix_millis("event_ts"))
        .select(
            F.pmod(F.xxhash64("ride_id"), F.lit(buckets)).cast("int").alias("bucket"),
            "ride_id",
            "event_seq",
            F.coalesce("kafka_offset", F.lit(UNKNOWN)).alias("arrival"),
            F.coalesce("event_ms", F.lit(UNKNOWN)).alias("event_ms"),
            F.to_json(F.struct(F.col("event_ms").alias("event_ts"), *SLOT_FIELDS[1:])).alias("slot"),
            "event_ts",
        )
    )
    closed = rows.groupBy("bucket").transformWithStateInPandas(
        RideSlots(timeout_sec * 1000, delay_sec * 1000),
        OUTPUT,
        "Append",
        "EventTime",
    )
    values = closed.withColumns({s: F.from_json(s, _SLOT_VALUES) for s in _SLOT_NAMES})
    slots = values.select(
        "ride_id",
        *[
            F.when(
                F.col(s).isNotNull(),
                F.col(s).withField("event_ts", F.timestamp_millis(F.col(f"{s}.event_ts"))),
            ).alias(s)
            for s in _SLOT_NAMES
        ],
        *[f"first_{t}" for t in TERMINAL_TYPES],
    )
    return (
        derive_session(slots)
        .withColumn("terminal_state", F.coalesce("terminal_state", F.lit("abandoned")))
        .select(*RIDE_SESSION.names)
    )
