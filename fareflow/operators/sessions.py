"""Fold ride events into one session row per ride."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.geo import haversine_km
from fareflow.functions.rides import default_surge, late_arrival
from fareflow.functions.times import elapsed_sec, seconds
from fareflow.schemas import EVENT_ORDINALS, RIDE_SESSION, SESSION_TIMEOUT_SEC, TERMINAL_TYPES

SLOT_FIELDS = (
    "event_ts", "rider_id", "driver_id", "city_id", "pickup_lat", "pickup_lon", "dropoff_lat",
    "dropoff_lon", "fare_cents", "surge_multiplier", "promo_code",
)


def fold_slots(events: DataFrame, arrival: str = "kafka_offset") -> DataFrame:
    """One row per ride with a struct ``s1`` … ``s6`` per lifecycle ordinal.

    The last arrival of an ordinal fills its slot; the terminal type is the one that
    arrived first. One aggregation on ``ride_id``: copies collapse on the map side.
    """
    slot = f"struct({', '.join(SLOT_FIELDS)})"
    slots = [
        F.expr(f"max_by({slot}, {arrival}) FILTER (WHERE event_type = '{name}')").alias(f"s{n}")
        for name, n in EVENT_ORDINALS.items()
    ]
    first_seen = [
        F.expr(f"min({arrival}) FILTER (WHERE event_type = '{name}')").alias(f"first_{name}")
        for name in TERMINAL_TYPES
    ]
    known = events.where(F.col("event_type").isin(*EVENT_ORDINALS))
    return known.groupBy("ride_id").agg(*slots, *first_seen)


def _first_known(field: str) -> str:
    """SQL for the field's first known value in ordinal order."""
    return f"coalesce({', '.join(f's{n}.{field}' for n in sorted(EVENT_ORDINALS.values()))})"


def derive_session(slots: DataFrame) -> DataFrame:
    """Session columns from slots; ``terminal_state`` is null while the ride is open.

    Keeps ``last_event_ts`` so that callers can decide on a timeout.
    """
    ts = {name: f"s{n}.event_ts" for name, n in EVENT_ORDINALS.items()}
    known = ("rider_id", "driver_id", "city_id", "promo_code", "surge_multiplier", "pickup_lat",
             "pickup_lon", "dropoff_lat", "dropoff_lon")
    filled = " + ".join(f"int(s{n} IS NOT NULL)" for n in EVENT_ORDINALS.values())
    rows = slots.selectExpr(
        "ride_id",
        *[f"{_first_known(c)} AS {c}" for c in known],
        "CASE WHEN first_completed < coalesce(first_cancelled, first_completed + 1) THEN 'completed'"
        " WHEN first_cancelled IS NOT NULL THEN 'cancelled' END AS terminal_state",
        f"{filled} AS event_seq",
        f"greatest({', '.join(ts.values())}) AS last_event_ts",
        f"{ts['requested']} AS requested_known",
        *[f"{ts[name]} AS {name}_ts" for name in ("matched", "driver_arrived", "started", *TERMINAL_TYPES)],
        f"s{EVENT_ORDINALS['completed']}.fare_cents AS fare_cents",
    )
    is_completed = F.col("terminal_state") == "completed"
    rows = rows.withColumns(
        {
            "surge_multiplier": default_surge(F.col("surge_multiplier")),
            "requested_ts": F.coalesce("requested_known", "last_event_ts"),
            "ended_ts": F.when(is_completed, F.col("completed_ts")).when(
                F.col("terminal_state") == "cancelled", F.col("cancelled_ts")
            ),
            "time_to_match_sec": elapsed_sec(F.col("matched_ts"), F.col("requested_known")),
            "time_to_pickup_sec": elapsed_sec(F.col("driver_arrived_ts"), F.col("matched_ts")),
            "ride_duration_sec": F.when(
                is_completed, elapsed_sec(F.col("completed_ts"), F.col("started_ts"))
            ),
            "haversine_distance_km": haversine_km(
                F.col("pickup_lat"), F.col("pickup_lon"), F.col("dropoff_lat"), F.col("dropoff_lon")
            ),
            "pickup_lat": F.coalesce("pickup_lat", F.lit(0.0)),
            "pickup_lon": F.coalesce("pickup_lon", F.lit(0.0)),
        }
    )
    duration = F.col("ride_duration_sec")
    return rows.withColumns(
        {
            "is_late_arrival": late_arrival(F.col("time_to_pickup_sec")),
            "avg_speed_kmh": F.when(
                duration > 0, F.col("haversine_distance_km") / (duration / 3600.0)
            ),
        }
    ).select(*RIDE_SESSION.names, "last_event_ts")


def close_sessions(
    folded: DataFrame, watermark: Column, timeout_sec: int = SESSION_TIMEOUT_SEC
) -> DataFrame:
    """Keep closed rides: terminal ones, and those silent for strictly longer than the timeout."""
    timed_out = watermark > F.col("last_event_ts") + seconds(timeout_sec)
    return (
        folded.where(F.col("terminal_state").isNotNull() | timed_out)
        .withColumn("terminal_state", F.coalesce("terminal_state", F.lit("abandoned")))
        .select(*RIDE_SESSION.names)
    )


def until_terminal(events: DataFrame, arrival: str = "kafka_offset") -> DataFrame:
    """Events up to the arrival of their ride's first terminal event (closed is final)."""
    closing = (
        events.where(F.col("event_type").isin(*TERMINAL_TYPES))
        .groupBy("ride_id")
        .agg(F.min(arrival).alias("_closed_at"))
    )
    return (
        events.join(closing, "ride_id", "left")
        .where(F.col("_closed_at").isNull() | (F.col(arrival) <= F.col("_closed_at")))
        .drop("_closed_at")
    )


def build_sessions(
    events: DataFrame,
    arrival: str = "kafka_offset",
    watermark: Column | None = None,
    as_of_arrival: bool = False,
) -> DataFrame:
    """Closed sessions of a batch of ride events.

    The default watermark is the newest event time of the batch, as a scalar subquery.
    """
    if as_of_arrival:
        events = until_terminal(events, arrival)
    if watermark is None:
        watermark = events.agg(F.max("event_ts")).scalar()
    return close_sessions(derive_session(fold_slots(events, arrival)), watermark)


def with_session_ts(sessions: DataFrame) -> DataFrame:
    """Add the event time of a session: its end, or its request if it never ended."""
    return sessions.withColumn("session_ts", F.coalesce("ended_ts", "requested_ts"))
