"""Time-window aggregates, usable on batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions.rides import match_bucket, rate
from fareflow.operators.quantiles import histogram_quantiles
from fareflow.operators.slices import null_safe_join
from fareflow.schemas import MATCH_BUCKET_SEC


def city_metrics(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """Tumbling-window counts and rates per city."""
    kind = F.col("event_type")
    counted = events.groupBy(F.window("event_ts", width).alias("w"), "city_id").agg(
        F.count_if(kind == "requested").alias("requests"),
        F.count_if(kind == "completed").alias("completes"),
        F.count_if(kind == "cancelled").alias("cancels"),
        F.avg(F.when(kind == "requested", F.col("surge_multiplier"))).alias("mean_surge"),
    )
    ended = F.col("completes") + F.col("cancels")
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "city_id",
        "requests",
        "completes",
        "cancels",
        rate(F.col("completes"), ended).alias("completion_rate"),
        rate(F.col("cancels"), ended).alias("cancellation_rate"),
        "mean_surge",
    )


def match_histogram(sessions: DataFrame, width: str = "1 minute") -> DataFrame:
    """Tumbling-window histogram of time to match per city."""
    return (
        sessions.where(F.col("time_to_match_sec").isNotNull())
        .groupBy(
            F.window("session_ts", width).alias("w"),
            "city_id",
            match_bucket(F.col("time_to_match_sec")).alias("bucket"),
        )
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "city_id",
            "bucket",
            "cnt",
        )
    )


def match_quantiles(hist: DataFrame) -> DataFrame:
    """p50 and p95 time to match per window and city from the histogram."""
    return histogram_quantiles(
        hist,
        ("window_start", "window_end", "city_id"),
        "bucket",
        "cnt",
        {"p50_time_to_match_sec": 0.50, "p95_time_to_match_sec": 0.95},
        MATCH_BUCKET_SEC,
        "matched_rides",
    )


def city_metrics_full(metrics: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Counts of every window with its quantiles where there are any."""
    return null_safe_join(
        metrics,
        quantiles.select(
            "window_start", "city_id", "p50_time_to_match_sec", "p95_time_to_match_sec"
        ),
        ("window_start", "city_id"),
        "left",
    )
