"""The sessionizer's state: rides share buckets, and each ride is still closed by itself."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from fareflow.streaming import jobs
from fareflow.streaming.sessionizer import UNKNOWN, RideSlots, sessionize
from tests.rides import T0, event, full_ride
from tests.test_streaming import feed, stream

HOUR = 3600 * 1000


def test_rides_of_one_bucket_close_one_by_one(spark, folder):
    feed(spark, folder, [
        [*full_ride("a"), event("requested", T0, "b"), event("requested", T0 + HOUR, "c")],
        [event("requested", T0 + 2 * HOUR, "d")],
        [event("requested", T0 + 2 * HOUR + 1, "e")],
        [event("cancelled", T0 + HOUR + 5, "c")],
        [event("cancelled", T0 + HOUR + 5, "a"), event("matched", T0 + HOUR + 5, "b")],
    ])
    out = jobs.run_to_table(sessionize(stream(spark, folder), buckets=1), folder)
    found = {r["ride_id"]: (r["terminal_state"], r["event_seq"]) for r in out.collect()}
    assert found == {"a": ("completed", 5), "b": ("abandoned", 1), "c": ("cancelled", 2)} and out.count() == 3
    kept = {}
    for name in ("open", "closed"):
        state = spark.read.format("statestore").option("stateVarName", name).load(f"{folder}/checkpoint")
        kept[name] = sorted(r[0] for r in state.select("list_element.ride_id").collect())
        assert state.select("key").distinct().count() == 1
    assert kept == {"open": ["d", "e"], "closed": ["a", "b", "c"]}


class Listed(list):
    """A list state that counts the calls made to it."""

    calls = 0

    def get(self):
        self.calls += 1
        return iter(list(self))

    def put(self, rows):
        self.calls += 1
        self[:] = rows

    def appendList(self, rows):
        self.calls += 1
        self.extend(rows)

    def clear(self):
        self.calls += 1
        self[:] = []


class Handle:
    def __init__(self):
        self.lists, self.timers = {}, []

    def getListState(self, name, schema):
        return self.lists.setdefault(name, Listed())

    def registerTimer(self, at):
        self.timers.append(at)


class At:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def bucket():
    slots = RideSlots(2 * HOUR, 2 * HOUR)
    slots.init(Handle())
    return slots


def rows(*events):
    return iter([pd.DataFrame(events, columns=["ride_id", "event_seq", "arrival", "event_ms", "slot"])])


def test_calls_to_the_state_do_not_grow_with_the_rides():
    for n in (10, 1000):
        slots = bucket()
        for _ in range(2):
            list(slots.handleInputRows((0,), rows(*[(f"r{i}", 1 if i % 2 else 5, i, T0 + i, "{}") for i in range(n)]), At(0)))
        lists = slots.handle.lists
        assert (len(lists["open"]), len(lists["closed"])) == (n // 2, n // 2)
        assert sum(x.calls for x in lists.values()) <= 8 and len(slots.handle.timers) == 1


def test_a_timer_stands_for_the_earliest_open_ride():
    slots = bucket()
    list(slots.handleInputRows((0,), rows(("late", 1, 0, T0 + 50, "{}"), ("early", 1, 1, T0, "{}")), At(0)))
    assert slots.handle.timers == [T0 + 1]
    list(slots.handleInputRows((0,), rows(("early", 2, 2, T0 + 90, "{}"), ("first", 1, 3, T0 - 9, "{}")), At(0)))
    assert slots.handle.timers == [T0 + 1, T0 - 8]
    (out,) = slots.handleExpiredTimer((0,), At(T0 + 1), None)
    assert list(out["ride_id"]) == ["first"] and slots.handle.timers[-1] == T0 + 51
    out = pd.concat(slots.handleExpiredTimer((0,), At(T0 + 91), None))
    assert sorted(out["ride_id"]) == ["early", "late"] and not slots.handle.lists["open"]


def test_unknown_offsets_and_times():
    """A known arrival is the later of two and the first of them; a ride without any time is never overdue."""
    slots = bucket()
    given = rows(("a", 5, UNKNOWN, T0, "x"), ("a", 5, 7, T0, "y"), ("a", 5, UNKNOWN, T0, "z"), ("b", 6, UNKNOWN, T0, "x"), ("c", 1, 1, UNKNOWN, "x"))
    (out,) = slots.handleInputRows((0,), given, At(0))
    found = {r.ride_id: (r.s5, r.s6, r.first_completed, r.first_cancelled) for r in out.itertuples()}
    assert found == {"a": ("y", None, 7, None), "b": (None, "x", None, None)}
    assert not slots.handle.timers and list(slots.handleExpiredTimer((0,), At(T0), None)) == []
    assert [r[0] for r in slots.handle.lists["open"]] == ["c"]


def test_values_pass_through_the_state_unchanged(spark, folder):
    ride = [{**e, "pickup_lat": 0.1 + 0.2, "rider_id": 'r"\\é\n\u2028'} for e in full_ride("a")]
    feed(spark, folder, [ride[:2], ride[2:]])
    out = jobs.run_to_table(sessionize(stream(spark, folder)), folder)
    row = out.select("rider_id", "pickup_lat", F.unix_millis("requested_ts").alias("ms")).first()
    assert (row["rider_id"], row["pickup_lat"], row["ms"]) == ('r"\\é\n\u2028', 0.1 + 0.2, T0)
