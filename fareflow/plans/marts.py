"""Staging, intermediate and mart tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.rides import driver_tier, rate
from fareflow.functions.times import seconds
from fareflow.operators.joins import left_join_unique
from fareflow.operators.latest import latest_per_key
from fareflow.operators.quantiles import exact_quantiles
from fareflow.operators.shifts import driver_shifts
from fareflow.operators.slices import null_safe_join
from fareflow.operators.upsert import replace_keys
from fareflow.schemas import FACT_LOOKBACK_SEC

# --- staging: renames and casts ------------------------------------------------------------


def stage_events(landed: DataFrame) -> DataFrame:
    return landed.withColumn("fare_cents", F.col("fare_cents").cast("long")).withColumnRenamed(
        "event_ts", "event_at"
    )


def stage_sessions(sessions: DataFrame) -> DataFrame:
    times = ("requested", "matched", "driver_arrived", "started", "ended")
    return sessions.withColumn("fare_cents", F.col("fare_cents").cast("long")).withColumnsRenamed(
        {f"{t}_ts": f"{t}_at" for t in times}
    )


def stage_payments(payments: DataFrame) -> DataFrame:
    return payments.withColumn("amount_cents", F.col("amount_cents").cast("long")).withColumnRenamed(
        "payment_ts", "paid_at"
    )


def stage_locations(pings: DataFrame) -> DataFrame:
    return pings.withColumnRenamed("ts", "pinged_at")


def dim_cities(seed: DataFrame) -> DataFrame:
    return seed.withColumnRenamed("name", "city_name")


# --- rides -----------------------------------------------------------------------------------


def enriched_rides(sessions: DataFrame, payments: DataFrame, cities: DataFrame) -> DataFrame:
    """Staged sessions with their payment, where there is one, and their city name."""
    paid = payments.select(
        "ride_id",
        "txn_id",
        F.col("amount_cents").alias("paid_amount_cents"),
        F.col("status").alias("payment_status"),
        F.col("method").alias("payment_method"),
        "paid_at",
    )
    return (
        left_join_unique(sessions, paid, "ride_id")
        .withColumn("is_paid", F.col("txn_id").isNotNull())
        .join(cities.select("city_id", "city_name"), "city_id", "left")
    )


FACT_COLUMNS = (
    "ride_id", "rider_id", "driver_id", "city_id", "city_name", "terminal_state", "event_seq",
    "requested_at", "matched_at", "driver_arrived_at", "started_at", "ended_at",
    "time_to_match_sec", "time_to_pickup_sec", "ride_duration_sec", "haversine_distance_km",
    "avg_speed_kmh", "is_late_arrival", "fare_cents", "surge_multiplier", "promo_code", "txn_id",
    "paid_amount_cents", "payment_status", "payment_method", "paid_at", "is_paid", "ingested_at",
)


def ride_fact(enriched: DataFrame) -> DataFrame:
    return enriched.select(*FACT_COLUMNS)


def fact_batch(
    target: DataFrame, enriched: DataFrame, lookback_sec: int = FACT_LOOKBACK_SEC
) -> DataFrame:
    """Source rows requested no earlier than the target's newest request less the lookback.

    The bound is a scalar subquery, so the scan of the source can prune on it. An empty target
    takes everything.
    """
    newest = target.agg(F.max("requested_at")).scalar()
    bound = F.coalesce(newest - seconds(lookback_sec), F.lit("1900-01-01").cast("timestamp"))
    return ride_fact(enriched.where(F.col("requested_at") >= bound))


def merge_fact(
    target: DataFrame, enriched: DataFrame, lookback_sec: int = FACT_LOOKBACK_SEC
) -> DataFrame:
    """The ride fact after one incremental run."""
    return replace_keys(target, fact_batch(target, enriched, lookback_sec), ["ride_id"])


def city_hourly(rides: DataFrame) -> DataFrame:
    """Hourly rollup of the ride fact per city, with exact quantiles of time to match."""
    keys = ("city_id", "city_name", "hour_start")
    rows = rides.withColumn("hour_start", F.date_trunc("HOUR", "requested_at"))
    state = F.col("terminal_state")
    n = F.count(F.lit(1))
    rolled = rows.groupBy(*keys).agg(
        n.alias("rides_closed"),
        F.count_if(state == "completed").alias("rides_completed"),
        F.count_if(state == "cancelled").alias("rides_cancelled"),
        F.count_if(state == "abandoned").alias("rides_abandoned"),
        rate(F.count_if(state == "completed"), n).alias("completion_rate"),
        F.avg("surge_multiplier").alias("avg_surge"),
        F.sum(F.when(state == "completed", F.col("fare_cents"))).alias("gross_fares_cents"),
        F.sum(
            F.when(F.col("payment_status") == "completed", F.col("paid_amount_cents"))
        ).alias("collected_cents"),
        F.count_if("is_late_arrival").alias("late_arrivals"),
    )
    quantiles = exact_quantiles(
        rows,
        keys,
        "time_to_match_sec",
        {"p50_time_to_match_sec": 0.5, "p95_time_to_match_sec": 0.95},
    ).drop("n_values")
    return null_safe_join(rolled, quantiles, keys, "left")


# --- drivers ---------------------------------------------------------------------------------


def completed_per_driver(sessions: DataFrame) -> DataFrame:
    return (
        sessions.where((F.col("terminal_state") == "completed") & F.col("driver_id").isNotNull())
        .groupBy("driver_id")
        .agg(F.count(F.lit(1)).alias("completed_rides"))
    )


def current_drivers(
    pings: DataFrame, sessions: DataFrame, newest: Sequence[str] = ("pinged_at",)
) -> DataFrame:
    """Latest ping per driver with lifetime completed rides and the tier they earn."""
    latest = latest_per_key(
        pings.select("driver_id", "city_id", "status", *newest), ["driver_id"], *newest
    )
    rides = F.coalesce("completed_rides", F.lit(0))
    return latest.join(completed_per_driver(sessions), "driver_id", "left").select(
        "driver_id",
        "city_id",
        "status",
        F.col("pinged_at").alias("last_seen_at"),
        rides.alias("completed_rides"),
        driver_tier(rides).alias("tier"),
    )


SNAPSHOT_CHECKED = ("status", "tier", "city_id")


def dim_drivers(history: DataFrame) -> DataFrame:
    """Driver versions with their key and validity."""
    return history.select(
        F.concat_ws(".", "driver_id", F.date_format("valid_from", "yyyyMMddHHmmssSSS")).alias(
            "driver_version_key"
        ),
        "driver_id",
        "city_id",
        "status",
        "tier",
        "completed_rides",
        "last_seen_at",
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def shift_fact(pings: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    return driver_shifts(pings, order)


def with_ingest_time(df: DataFrame, ingested_at: Column) -> DataFrame:
    return df.withColumn("ingested_at", ingested_at)
