"""Sources, scalars and the session fold over the driver's events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.checks.registry import query
from fareflow.operators.sessions import build_sessions
from fareflow.sources.derived import DriverTables

SESSION_COLUMNS = """ride_id, rider_id, driver_id, city_id, terminal_state, event_seq, requested_ts, matched_ts,
 driver_arrived_ts, started_ts, ended_ts, time_to_match_sec, time_to_pickup_sec, ride_duration_sec,
 round(haversine_distance_km, 6) AS haversine_distance_km, round(avg_speed_kmh, 6) AS avg_speed_kmh, is_late_arrival,
 fare_cents, surge_multiplier, promo_code, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round values made by trigonometry, which differ in the last bit between engines."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("ride_event_stream", "SELECT * FROM ride_events", ("ride_events",))
def ride_event_stream(t: DriverTables) -> DataFrame:
    return t.ride_events


@query("session_fold", f"SELECT {SESSION_COLUMNS} FROM sessions", ("sessions",))
def session_fold(t: DriverTables) -> DataFrame:
    return rounded(build_sessions(t.ride_events), "haversine_distance_km", "avg_speed_kmh")
