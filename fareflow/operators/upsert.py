"""Keyed merges of a batch into a table, as DataFrame rewrites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.operators.latest import first_per_key


def insert_missing(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """First wins: rows of ``batch`` whose key is new, the earliest of each key."""
    fresh = first_per_key(batch, keys, order)
    return fresh.join(existing.select(*keys), list(keys), "left_anti")


def upsert_first(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The table after a first-wins merge."""
    return existing.unionByName(insert_missing(existing, batch, keys, order))


def upsert_last(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The table after a last-wins merge; ``order`` puts the winning row first."""
    winners = first_per_key(batch, keys, order)
    return replace_keys(existing, winners, keys)


def replace_keys(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` (unique on ``keys``) in place of the existing rows with those keys."""
    kept = existing.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch)


# Columns a richer close of a session replaces; the others keep their first value.
REPLACED_BY_RICHER = (
    "terminal_state", "event_seq", "ended_ts", "time_to_match_sec", "time_to_pickup_sec",
    "ride_duration_sec", "haversine_distance_km", "avg_speed_kmh", "is_late_arrival",
    "fare_cents", "promo_code",
)


def upsert_richer(
    existing: DataFrame,
    batch: DataFrame,
    key: str = "ride_id",
    seq: str = "event_seq",
    arrival: str = "arrival",
    replaced: Sequence[str] = REPLACED_BY_RICHER,
) -> DataFrame:
    """The table after merging rows one by one, each replacing only a strictly poorer one.

    A key's row ends with the ``replaced`` columns of its first arrival at the highest
    ``seq`` and the other columns of its first arrival. Existing rows arrive before the batch.
    Both picks are aggregations, so repeats of one key collapse on the map side.
    """
    fixed = [c for c in existing.columns if c != key and c not in replaced]
    taken = [c for c in existing.columns if c in replaced]
    old = existing.withColumn("_at", F.lit(None).cast("long"))
    new = batch.select(*existing.columns, F.col(arrival).cast("long").alias("_at"))
    rows = old.unionByName(new)
    # Structs order null first: an existing row is the earliest, and wins ties on seq.
    earliest = F.struct(F.col("_at"))
    richest = F.struct(F.col(seq), F.col("_at").isNull(), -F.col("_at"))
    return (
        rows.groupBy(key)
        .agg(
            F.min_by(F.struct(*fixed), earliest).alias("_first"),
            F.max_by(F.struct(*taken), richest).alias("_best"),
        )
        .select(key, "_first.*", "_best.*")
        .select(*existing.columns)
    )
