from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fareflow.operators.sessions import build_sessions, until_terminal
from tests.rides import ARRIVE, DROPOFF, END, MATCH, PICKUP, START, T0, collect, event, events_df, full_ride

HOURS2 = 2 * 3600 * 1000


def sessions(spark, events, watermark_ms=T0, **kwargs):
    watermark = F.timestamp_millis(F.lit(watermark_ms))
    return collect(build_sessions(events_df(spark, events), watermark=watermark, **kwargs))


def one(spark, events, **kwargs):
    rows = sessions(spark, events, **kwargs)
    assert len(rows) == 1
    return rows[0]


def test_full_ride(spark):
    from math import asin, cos, radians, sin, sqrt

    s = one(spark, full_ride())
    a, b = map(radians, (PICKUP[0], DROPOFF[0]))
    h = sin((b - a) / 2) ** 2 + cos(a) * cos(b) * sin(radians(DROPOFF[1] - PICKUP[1]) / 2) ** 2
    km = 2 * 6371.0088 * asin(sqrt(h))
    assert (s["terminal_state"], s["event_seq"], s["driver_id"]) == ("completed", 5, "d-1")
    assert (s["time_to_match_sec"], s["time_to_pickup_sec"], s["ride_duration_sec"]) == (30.0, 180.0, 900.0)
    assert s["haversine_distance_km"] == pytest.approx(km)
    assert s["avg_speed_kmh"] == pytest.approx(km / 0.25)
    assert s["is_late_arrival"] is False and s["fare_cents"] == 31_400
    assert (s["requested_ts"], s["matched_ts"], s["driver_arrived_ts"], s["started_ts"], s["ended_ts"]) == (
        T0, MATCH, ARRIVE, START, END)


def test_arrival_order_does_not_matter(spark):
    events = full_ride()
    want = one(spark, events)
    for seed in range(3):
        mixed = events[:]
        random.Random(seed).shuffle(mixed)
        assert one(spark, mixed) == want


def test_repeats_fold_once_and_the_last_arrival_fills_the_slot(spark):
    events = full_ride()
    assert one(spark, [*events, events[1], events[4]])["event_seq"] == 5
    changed = {**events[4], "fare_cents": 99}
    assert one(spark, [*events, changed])["fare_cents"] == 99


def test_cancelled_ride_has_no_trip(spark):
    s = one(spark, [event("requested", T0), event("matched", MATCH), event("cancelled", T0 + 90_000)])
    assert s["terminal_state"] == "cancelled" and s["ended_ts"] == T0 + 90_000
    assert s["ride_duration_sec"] is None and s["fare_cents"] is None and s["time_to_match_sec"] == 30.0


def test_first_arriving_terminal_wins(spark):
    s = one(spark, [event("requested", T0), event("cancelled", T0 + 9), event("completed", END, fare_cents=5)])
    assert s["terminal_state"] == "cancelled" and s["ended_ts"] == T0 + 9 and s["fare_cents"] == 5


@pytest.mark.parametrize("ms,late", [(600_000, False), (601_000, True)])
def test_late_arrival_is_strict(spark, ms, late):
    events = [event("requested", T0), event("matched", MATCH), event("driver_arrived", MATCH + ms),
              event("completed", MATCH + 1_500_000, fare_cents=1)]
    assert one(spark, events)["is_late_arrival"] is late


def test_missing_start_keeps_distance(spark):
    events = [e for e in full_ride() if e["event_type"] not in ("started", "driver_arrived")]
    s = one(spark, events)
    assert s["ride_duration_sec"] is None and s["avg_speed_kmh"] is None
    assert s["haversine_distance_km"] is not None and s["time_to_pickup_sec"] is None


def test_abandoned_strictly_after_the_timeout(spark):
    events = [event("requested", T0), event("matched", MATCH)]
    assert sessions(spark, events, watermark_ms=MATCH + HOURS2) == []
    s = one(spark, events, watermark_ms=MATCH + HOURS2 + 1)
    assert s["terminal_state"] == "abandoned" and s["ended_ts"] is None and s["event_seq"] == 2


def test_defaults(spark):
    s = one(spark, [event("completed", END, surge_multiplier=0.0, pickup_lat=None, pickup_lon=None)])
    assert s["requested_ts"] == END and s["surge_multiplier"] == 1.0
    assert s["pickup_lat"] == 0.0 and s["pickup_lon"] == 0.0 and s["haversine_distance_km"] is None


def test_promo_from_any_event_and_clamped_times(spark):
    events = full_ride()
    events[3] = {**events[3], "payload_version": 2, "promo_code": "RAIN7"}
    assert one(spark, events)["promo_code"] == "RAIN7"
    back = [event("requested", T0 + 50), event("matched", T0), event("cancelled", T0 + 60)]
    assert one(spark, back)["time_to_match_sec"] == 0.0


def test_unknown_types_are_left_out(spark):
    assert one(spark, [*full_ride(), event("teleported", T0)])["event_seq"] == 5


def test_closed_is_final_as_of_arrival(spark):
    events = full_ride()
    delayed = [*events[:3], events[4], events[3]]
    assert one(spark, delayed)["event_seq"] == 5
    s = one(spark, delayed, as_of_arrival=True)
    assert s["event_seq"] == 4 and s["started_ts"] is None and s["ride_duration_sec"] is None
    assert until_terminal(events_df(spark, delayed)).count() == 4
