"""Rows that arrive behind the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions.times import seconds, whole_seconds
from fareflow.operators.slices import with_running
from fareflow.schemas import WATERMARK_DELAY_SEC

OFFSETS_PER_SLICE = 1_000_000


def with_watermark_before(
    events: DataFrame,
    delay_sec: int = WATERMARK_DELAY_SEC,
    partition: str = "kafka_partition",
    offset: str = "kafka_offset",
    event_ts: str = "event_ts",
    offsets_per_slice: int = OFFSETS_PER_SLICE,
) -> DataFrame:
    """Add ``watermark``: newest event time that arrived earlier in the partition, less the delay.

    Null on a partition's first row. A partition is cut into offset slices, so its rows spread
    over many tasks.
    """
    slice_id = F.floor(F.col(offset) / offsets_per_slice).cast("long")
    rows = with_running(
        events, [partition], [offset], slice_id, F.col(event_ts), "_newest", "max", False
    )
    return rows.withColumn("watermark", F.col("_newest") - seconds(delay_sec)).drop("_newest")


def late_events(events: DataFrame, delay_sec: int = WATERMARK_DELAY_SEC, **columns) -> DataFrame:
    """Ride events older than the watermark they met, with the whole seconds they were late."""
    return (
        with_watermark_before(events, delay_sec, **columns)
        .where(F.col("event_ts") < F.col("watermark"))
        .select(
            "event_id",
            "ride_id",
            "event_type",
            "event_ts",
            "city_id",
            whole_seconds(F.col("event_ts"), F.col("watermark")).alias("late_by_sec"),
        )
    )
