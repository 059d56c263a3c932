"""Queries behind the dashboards and the map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions.rides import rate
from fareflow.functions.times import seconds
from fareflow.operators.latest import latest_per_key
from fareflow.operators.quantiles import exact_quantiles


def city_list(cities: DataFrame) -> DataFrame:
    return cities.select("city_id", "city_name", "center_lat", "center_lon").orderBy("city_id")


def ride_totals(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count(F.lit(1)).alias("rides_closed"),
        F.count_if(F.col("terminal_state") == "completed").alias("rides_completed"),
        F.max("requested_ts").alias("max_requested_ts"),
    )


def lifetime_totals(rides: DataFrame, shifts: DataFrame) -> DataFrame:
    """Rides, completion rate, mean surge, mean on-trip share and shifts, in one row."""
    n = F.count(F.lit(1))
    of_shifts = shifts.agg(
        F.struct(
            F.avg("on_trip_share").alias("driver_utilisation"), F.count(F.lit(1)).alias("shifts")
        ).alias("s")
    )
    return (
        rides.agg(
            n.alias("rides"),
            rate(F.count_if(F.col("terminal_state") == "completed"), n).alias("completion_rate"),
            F.avg("surge_multiplier").alias("avg_surge"),
        )
        .withColumn("s", of_shifts.scalar())
        .select("rides", "completion_rate", "avg_surge", "s.*")
    )


def city_scorecard(hourly: DataFrame) -> DataFrame:
    closed, completed = F.sum("rides_closed"), F.sum("rides_completed")
    return hourly.groupBy("city_name").agg(
        closed.alias("rides_closed"),
        completed.alias("rides_completed"),
        F.sum("rides_cancelled").alias("rides_cancelled"),
        F.sum("rides_abandoned").alias("rides_abandoned"),
        rate(completed, closed).alias("completion_rate"),
        F.avg("avg_surge").alias("avg_surge"),
        F.sum("late_arrivals").alias("late_arrivals"),
    ).orderBy(F.col("rides_closed").desc())


def utilisation_by_city(shifts: DataFrame, cities: DataFrame) -> DataFrame:
    """Shift averages per city; a city without a name goes by its number.

    Shifts shrink to one row per city before the join.
    """
    means = ("on_trip_share", "active_minutes", "distance_km", "avg_speed_kmh")
    parts = shifts.groupBy("city_id").agg(
        F.count(F.lit(1)).alias("shifts"),
        *[F.sum(c).alias(f"sum_{c}") for c in means],
        *[F.count(c).alias(f"n_{c}") for c in means],
    )
    named = parts.join(cities.select("city_id", "city_name"), "city_id", "left")
    outs = ("on_trip_share", "avg_active_minutes", "avg_distance_km", "avg_speed_kmh")
    return named.groupBy(
        F.coalesce("city_name", F.col("city_id").cast("string")).alias("city")
    ).agg(
        F.sum("shifts").alias("shifts"),
        *[
            F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}")).alias(out)
            for c, out in zip(means, outs, strict=True)
        ],
    ).orderBy(F.col("shifts").desc())


def rides_by_city(rides: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Rides and completion rate per time bucket and city."""
    n = F.count(F.lit(1))
    return (
        rides.groupBy(F.window("requested_at", width).alias("w"), "city_name")
        .agg(
            n.cast("double").alias("rides"),
            rate(F.count_if(F.col("terminal_state") == "completed"), n).alias("completion_rate"),
        )
        .select(F.col("w.start").alias("time"), "city_name", "rides", "completion_rate")
        .orderBy("time")
    )


def rides_per_minute(sessions: DataFrame, hours: int) -> DataFrame:
    """Rides requested per minute and city in the last ``hours`` before the newest request."""
    newest = sessions.agg(F.max("requested_ts")).scalar()
    return (
        sessions.where(F.col("requested_ts") > newest - seconds(hours * 3600))
        .groupBy(F.date_trunc("MINUTE", "requested_ts").alias("minute_ts"), "city_id")
        .agg(F.count(F.lit(1)).alias("rides"))
        .orderBy("minute_ts")
    )


def hour_over_hour(sessions: DataFrame) -> DataFrame:
    """Closed rides and completion rate of the last hour and of the one before."""
    newest = sessions.agg(F.max("requested_ts")).scalar()
    bucket = F.when(F.col("requested_ts") > newest - seconds(3600), "cur").otherwise("prev")
    done = (F.col("terminal_state") == "completed").cast("int")
    return (
        sessions.where(F.col("requested_ts") > newest - seconds(7200))
        .groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rides_closed"), F.avg(done).alias("completion_rate"))
    )


def p95_time_to_match(metrics_full: DataFrame, rides: DataFrame) -> DataFrame:
    """Mean window p95 over the newest 15 minutes, or the fact's p95 when no window has one."""
    newest = metrics_full.agg(F.max("window_end")).scalar()
    mean = (
        metrics_full.where(
            (F.col("window_end") > newest - seconds(900))
            & F.col("p95_time_to_match_sec").isNotNull()
        )
        .agg(F.avg("p95_time_to_match_sec").alias("p95_sec"))
    )
    # With a window value in hand this filter empties the fact at its scan.
    needed = rides.where(mean.scalar().isNull())
    fallback = exact_quantiles(needed, (), "time_to_match_sec", {"p95_sec": 0.95})
    return (
        mean.where(F.col("p95_sec").isNotNull())
        .withColumn("source", F.lit("1-minute windows"))
        .unionByName(fallback.select("p95_sec", F.lit("ride fact").alias("source")))
    )


def latest_positions(pings: DataFrame, newest: Sequence[str] = ("ts",)) -> DataFrame:
    return latest_per_key(pings, ["driver_id"], *newest).select(
        "driver_id", "ts", "lat", "lon", "speed_kmh", "status", "city_id"
    )


def latest_quality(results: DataFrame) -> DataFrame:
    """The newest run of each suite with its counts and failed expectations (null if none).

    The list holds one run's failures, so its length is bounded by the suite's size.
    """
    latest = latest_per_key(
        results.select("suite", "run_id", "run_at").distinct(), ["suite"], "run_at", "run_id"
    ).select("suite", "run_id", F.col("run_at").alias("latest_at"))
    label = F.concat(
        F.col("expectation"),
        F.coalesce(F.concat(F.lit(" ["), "column_name", F.lit("]")), F.lit("")),
    )
    failed = F.sort_array(F.collect_list(F.when(~F.col("success"), label)))
    return (
        results.join(latest, ["suite", "run_id"])
        .groupBy("suite", F.col("latest_at").alias("run_at"))
        .agg(
            F.max("mode").alias("mode"),
            F.count(F.lit(1)).alias("n_expectations"),
            F.count_if("success").alias("n_pass"),
            F.when(F.count_if(~F.col("success")) > 0, failed).alias("failed"),
        )
        .orderBy("suite")
    )


def versions_with_promo(events: DataFrame) -> DataFrame:
    return events.groupBy("payload_version").agg(
        F.count(F.lit(1)).alias("n_events"), F.count("promo_code").alias("n_promo")
    )
