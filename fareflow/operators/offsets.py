"""Offset ledgers: how far each consumer group has processed each partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEDGER_KEYS = ("consumer_group", "topic", "partition")


def batch_offsets(messages: DataFrame, consumer_group: str) -> DataFrame:
    """Highest offset per partition of a batch, poison included."""
    return (
        messages.groupBy("topic", "partition")
        .agg(F.max("offset").alias("kafka_offset"))
        .select(F.lit(consumer_group).alias("consumer_group"), "topic", "partition", "kafka_offset")
    )


def advance_ledger(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """The ledger after a batch; an offset never moves back."""
    return (
        ledger.unionByName(batch)
        .groupBy(*LEDGER_KEYS)
        .agg(F.max("kafka_offset").alias("kafka_offset"))
    )


def unprocessed(messages: DataFrame, ledger: DataFrame, consumer_group: str) -> DataFrame:
    """Messages behind the ledger's position; partitions it does not know start at their beginning.

    A ledger has one row per source partition, so it is small next to any batch; the adaptive
    planner broadcasts it by its measured size.
    """
    done = ledger.where(F.col("consumer_group") == consumer_group).select(
        "topic", "partition", F.col("kafka_offset").alias("_done")
    )
    return (
        messages.join(done, ["topic", "partition"], "left")
        .where(F.col("_done").isNull() | (F.col("offset") > F.col("_done")))
        .drop("_done")
    )
