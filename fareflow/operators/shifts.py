"""Driver shifts and ping sessions: gaps and islands over the ping stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.geo import haversine_km
from fareflow.functions.times import seconds, slice_of, whole_seconds
from fareflow.operators.slices import PLACE, chain_islands, islands_in_slices, number_islands
from fareflow.schemas import PING_SESSION_GAP_SEC, SHIFT_GAP_SEC

SLICE_SEC = 3600


def numbered_shifts(
    pings: DataFrame,
    order: Sequence[str] = ("ts",),
    gap_sec: int = SHIFT_GAP_SEC,
    slice_sec: int = SLICE_SEC,
) -> DataFrame:
    """Pings with ``shift_seq``, ``is_new`` and ``step_km`` from the ping before.

    A shift opens at a driver's first ping, after a gap strictly longer than ``gap_sec``, and
    after an offline ping.
    """
    rows = number_islands(
        pings,
        ["driver_id"],
        order,
        slice_of(F.col("ts"), slice_sec),
        ["ts", "lat", "lon", "status"],
        (F.col("ts") > F.col("prev.ts") + seconds(gap_sec)) | (F.col("prev.status") == "offline"),
        "shift_seq",
    )
    step = haversine_km(F.col("prev.lat"), F.col("prev.lon"), F.col("lat"), F.col("lon"))
    return rows.withColumn("step_km", F.coalesce(step, F.lit(0.0))).drop("prev")


def _step_km() -> Column:
    step = haversine_km(F.col("prev.lat"), F.col("prev.lon"), F.col("lat"), F.col("lon"))
    return F.coalesce(step, F.lit(0.0))


def _opens_shift(gap_sec: int) -> Column:
    return (F.col("ts") > F.col("prev.ts") + seconds(gap_sec)) | F.col("prev.offline")


#: What the end of a slice tells the next one, and the start of one.
_ENDS = ("ts", "lat", "lon", "offline")


def shift_parts(
    pings: DataFrame,
    order: Sequence[str] = ("ts",),
    gap_sec: int = SHIFT_GAP_SEC,
    slice_sec: int = SLICE_SEC,
) -> DataFrame:
    """Shifts folded inside each slice of a driver's pings, one row a part: one pass over the pings.

    Far fewer rows than pings; ``joined_shifts`` reads them twice, so a caller who can write them does well to.
    """
    status = F.col("status")
    flagged = pings.withColumns({"offline": status == "offline", "on_trip": status == "on_trip"})
    needed = ("driver_id", "city_id", "speed_kmh", "on_trip", *_ENDS, *order)
    rows = islands_in_slices(
        flagged.select(*dict.fromkeys(needed)),
        ["driver_id"],
        order,
        slice_of(F.col("ts"), slice_sec),
        _ENDS,
        _opens_shift(gap_sec),
    )
    starts = F.col("prev").isNull() | F.coalesce(_opens_shift(gap_sec), F.lit(False))
    # One row has each end; column by column the buffers are plain numbers, which a hash aggregation needs.
    ends = [F.max(F.when(F.col("prev").isNull(), F.col(c))).alias(f"_first_{c}") for c in _ENDS]
    ends += [F.max(F.when(F.col("is_last"), F.col(c))).alias(f"_tail_{c}") for c in _ENDS]
    folded = rows.groupBy(*PLACE, "part").agg(
        F.min("city_id").alias("city_id"),
        F.min("ts").alias("shift_started_at"),
        F.max("ts").alias("shift_ended_at"),
        F.sum(F.when(starts, 0.0).otherwise(_step_km())).alias("distance_km"),
        F.count(F.lit(1)).alias("ping_count"),
        F.sum("speed_kmh").alias("speed_sum"),
        F.count("speed_kmh").alias("speed_count"),
        F.count_if("on_trip").alias("on_trip_count"),
        *ends,
    )
    return folded.select(
        *[c for c in folded.columns if not c.startswith(("_first_", "_tail_"))],
        *[F.struct(*[F.col(f"_{end}_{c}").alias(c) for c in _ENDS]).alias(end) for end in ("first", "tail")],
    )


def joined_shifts(parts: DataFrame, gap_sec: int = SHIFT_GAP_SEC) -> DataFrame:
    """One row per driver shift, from the parts of ``shift_parts`` with the same ``gap_sec``."""
    numbered = chain_islands(parts, _opens_shift(gap_sec))
    across = F.when(F.col("prev").isNotNull(), _step_km()).otherwise(0.0)
    rows = numbered.withColumns({"lat": F.col("first.lat"), "lon": F.col("first.lon")}).select(
        F.col("_key.driver_id").alias("driver_id"),
        F.col("island").alias("shift_seq"),
        (F.col("distance_km") + across).alias("distance_km"),
        *[c for c in parts.columns if c not in (*PLACE, "part", "distance_km", "first", "tail")],
    )
    span_us = F.unix_micros(F.max("shift_ended_at")) - F.unix_micros(F.min("shift_started_at"))
    n_pings = F.coalesce(F.sum("ping_count"), F.lit(0))
    return (
        rows.groupBy("driver_id", "shift_seq")
        .agg(
            F.min("city_id").alias("city_id"),
            (span_us / F.lit(1_000_000.0) / 60.0).alias("active_minutes"),
            F.min("shift_started_at").alias("shift_started_at"),
            F.max("shift_ended_at").alias("shift_ended_at"),
            F.sum("distance_km").alias("distance_km"),
            n_pings.alias("ping_count"),
            F.try_divide(F.sum("speed_sum"), F.sum("speed_count")).alias("avg_speed_kmh"),
            (F.sum("on_trip_count").cast("double") / n_pings).alias("on_trip_share"),
        )
        .select(
            F.concat_ws(".", "driver_id", "shift_seq").alias("shift_id"),
            "driver_id",
            "city_id",
            "shift_started_at",
            "shift_ended_at",
            "active_minutes",
            "distance_km",
            "ping_count",
            "avg_speed_kmh",
            "on_trip_share",
        )
    )


def driver_shifts(
    pings: DataFrame,
    order: Sequence[str] = ("ts",),
    gap_sec: int = SHIFT_GAP_SEC,
    slice_sec: int = SLICE_SEC,
) -> DataFrame:
    """One row per driver shift."""
    return joined_shifts(shift_parts(pings, order, gap_sec, slice_sec), gap_sec)


def _activity(first: str, last: str, speed: str) -> list:
    active = whole_seconds(F.col(first), F.col(last)).cast("double")
    return [
        (active / 60.0).alias("active_minutes"),
        (F.col(speed) * (active / 3600.0)).alias("distance_km"),
    ]


def ping_sessions(
    pings: DataFrame,
    order: Sequence[str] = ("ts",),
    gap_sec: int = PING_SESSION_GAP_SEC,
    slice_sec: int = SLICE_SEC,
) -> DataFrame:
    """Batch session windows per driver; a gap of exactly ``gap_sec`` still joins."""
    rows = number_islands(
        pings,
        ["driver_id"],
        order,
        slice_of(F.col("ts"), slice_sec),
        ["ts"],
        F.col("ts") > F.col("prev.ts") + seconds(gap_sec),
        "session_seq",
    )
    grouped = rows.groupBy("driver_id", "session_seq").agg(
        F.min("ts").alias("session_start"),
        F.max("ts").alias("_last"),
        F.min("city_id").alias("city_id"),
        F.count(F.lit(1)).alias("ping_count"),
        F.avg("speed_kmh").alias("_speed"),
    )
    return grouped.select(
        "driver_id",
        "session_start",
        (F.col("_last") + seconds(gap_sec)).alias("session_end"),
        "city_id",
        "ping_count",
        *_activity("session_start", "_last", "_speed"),
    )


def ping_session_windows(pings: DataFrame, gap_sec: int = PING_SESSION_GAP_SEC) -> DataFrame:
    """The same sessions through ``session_window``, for streaming DataFrames."""
    return (
        pings.groupBy("driver_id", F.session_window("ts", f"{gap_sec} seconds").alias("w"))
        .agg(
            F.min("city_id").alias("city_id"),
            F.count(F.lit(1)).alias("ping_count"),
            F.min("ts").alias("_first"),
            F.max("ts").alias("_last"),
            F.avg("speed_kmh").alias("_speed"),
        )
        .select(
            "driver_id",
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            "city_id",
            "ping_count",
            *_activity("_first", "_last", "_speed"),
        )
    )
