"""Ride-domain scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareflow.schemas import (
    EVENT_ORDINALS,
    GOLD_RIDES,
    LATE_ARRIVAL_SEC,
    MATCH_BUCKET_SEC,
    MATCH_LAST_BUCKET,
    SILVER_RIDES,
)


def event_ordinal(event_type: Column) -> Column:
    """Lifecycle ordinal of an event type; null for a type outside the lifecycle."""
    known = F.array(*map(F.lit, EVENT_ORDINALS))
    return F.nullif(F.array_position(known, event_type), F.lit(0)).cast("int")


def driver_tier(completed_rides: Column) -> Column:
    rides = F.coalesce(completed_rides, F.lit(0))
    return (
        F.when(rides >= GOLD_RIDES, "gold").when(rides >= SILVER_RIDES, "silver").otherwise("bronze")
    )


def late_arrival(time_to_pickup_sec: Column, limit_sec: float = LATE_ARRIVAL_SEC) -> Column:
    """True only when the pickup took strictly longer than the limit."""
    return F.coalesce(time_to_pickup_sec > limit_sec, F.lit(False))


def match_bucket(
    seconds: Column, width_sec: int = MATCH_BUCKET_SEC, last: int = MATCH_LAST_BUCKET
) -> Column:
    """Histogram bucket of a duration; the last bucket is open-ended."""
    return F.when(
        seconds.isNotNull(), F.least(F.floor(seconds / width_sec).cast("int"), F.lit(last))
    )


def rate(part: Column, whole: Column) -> Column:
    """part / whole as double, null when whole is zero."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def default_surge(surge: Column) -> Column:
    """Surge with an unknown or zero value read as 1.0."""
    return F.coalesce(F.nullif(surge, F.lit(0.0)), F.lit(1.0))
