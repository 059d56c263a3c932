"""Column contracts of every staging, intermediate and mart model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.operators.joins import orphans
from fareflow.operators.quality import Expectation, run_suite
from fareflow.schemas import (
    DRIVER_STATUSES,
    EVENT_ORDINALS,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    TERMINAL_STATES,
)


@dataclass(frozen=True)
class Contract:
    """Unique columns are never null either; ``refers`` maps a column to its parent's column."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    refers: dict[str, tuple[str, str]] = field(default_factory=dict)

    def expectations(self) -> list[Expectation]:
        return [
            *[Expectation("unique", c) for c in self.unique],
            *[Expectation("not_null", c) for c in (*self.unique, *self.not_null)],
            *[Expectation("in_set", c, values) for c, values in self.accepted.items()],
        ]


# Which columns of which model must hold what.
CONTRACTS = {
    "stg_rides__events": Contract(
        ("event_id",),
        ("ride_id", "event_seq", "event_type", "event_at", "rider_id", "city_id", "pickup_lat",
         "pickup_lon", "surge_multiplier", "payload_version", "kafka_partition", "kafka_offset",
         "ingested_at"),
        {"event_type": tuple(EVENT_ORDINALS), "payload_version": (1, 2)},
        {"city_id": ("dim_cities", "city_id")},
    ),
    "stg_rides__sessions": Contract(
        ("ride_id",),
        ("rider_id", "city_id", "terminal_state", "event_seq", "requested_at", "is_late_arrival",
         "surge_multiplier", "pickup_lat", "pickup_lon", "ingested_at"),
        {"terminal_state": TERMINAL_STATES},
    ),
    "stg_payments__transactions": Contract(
        ("txn_id",),
        ("ride_id", "amount_cents", "status", "method", "paid_at", "ingested_at"),
        {"status": PAYMENT_STATUSES, "method": PAYMENT_METHODS},
    ),
    "stg_drivers__locations": Contract(
        (),
        ("driver_id", "pinged_at", "lat", "lon", "speed_kmh", "heading", "status", "city_id"),
        {"status": DRIVER_STATUSES},
    ),
    "int_rides__enriched": Contract(("ride_id",)),
    "int_drivers__shifts": Contract(("shift_id",)),
    "int_drivers__current": Contract(("driver_id",)),
    "fct_rides": Contract(
        ("ride_id",),
        ("rider_id", "city_id", "terminal_state", "event_seq", "requested_at", "is_late_arrival",
         "surge_multiplier", "is_paid", "ingested_at"),
        {"terminal_state": TERMINAL_STATES},
        {"city_id": ("dim_cities", "city_id")},
    ),
    "fct_driver_shifts": Contract(
        ("shift_id",),
        ("driver_id", "city_id", "shift_started_at", "shift_ended_at", "active_minutes",
         "distance_km", "ping_count"),
    ),
    "dim_cities": Contract(("city_id", "city_name"), ("center_lat", "center_lon", "demand_weight")),
    "dim_drivers": Contract(
        ("driver_version_key",),
        ("driver_id", "city_id", "status", "tier", "completed_rides", "valid_from", "is_current"),
        {"status": DRIVER_STATUSES, "tier": ("bronze", "silver", "gold")},
    ),
    "agg_city_hourly": Contract(
        (),
        ("city_id", "hour_start", "rides_closed", "rides_completed", "rides_cancelled",
         "rides_abandoned", "late_arrivals"),
    ),
}


def check_model(
    df: DataFrame,
    model: str,
    parents: Mapping[str, DataFrame],
    run_id: Column,
    run_at: Column,
    mode: str = "fail",
) -> DataFrame:
    """Result rows of a model's contract; ``parents`` holds the models it refers to."""
    contract = CONTRACTS[model]
    results = run_suite(df, model, contract.expectations(), run_id, run_at, mode)
    for column, (parent, parent_key) in contract.refers.items():
        lost = orphans(df, parents[parent], column, parent_key).agg(
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("unexpected_count")
        )
        rows = df.agg(F.count(F.lit(1))).scalar()
        results = results.unionByName(
            lost.select(
                run_id.alias("run_id"),
                run_at.alias("run_at"),
                F.lit(model).alias("suite"),
                F.lit("relationships").alias("expectation"),
                F.lit(column).alias("column_name"),
                (F.col("unexpected_count") == 0).alias("success"),
                rows.alias("element_count"),
                "unexpected_count",
                F.lit(None).cast("string").alias("observed"),
                F.lit(mode).alias("mode"),
            )
        )
    return results
