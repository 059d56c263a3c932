"""Ride-payment joins, enrichment and referential checks.

A side that may repeat a key is only ever the probe side of an inner join, which the adaptive
skew join can split. Outer and anti results come from a second join against distinct keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions.times import seconds, whole_seconds
from fareflow.schemas import PAYMENT_BOUND_SEC


def _in_bound(bound_sec: int):
    paid = F.col("p.payment_ts")
    return (
        (F.col("s.ride_id") == F.col("p.ride_id"))
        & (paid >= F.col("s.session_ts"))
        & (paid <= F.col("s.session_ts") + seconds(bound_sec))
    )


def ride_payments(
    sessions: DataFrame, payments: DataFrame, bound_sec: int = PAYMENT_BOUND_SEC
) -> DataFrame:
    """Payments made from the end of their ride up to ``bound_sec`` later, both ends included.

    Works on batch DataFrames and on streams that carry watermarks.
    """
    return (
        sessions.alias("s")
        .join(payments.alias("p"), _in_bound(bound_sec))
        .select(
            "s.ride_id",
            "p.txn_id",
            "s.city_id",
            "s.terminal_state",
            "s.ended_ts",
            "s.fare_cents",
            "p.amount_cents",
            F.col("p.status").alias("payment_status"),
            F.col("p.method").alias("payment_method"),
            "p.payment_ts",
            whole_seconds(F.col("s.ended_ts"), F.col("p.payment_ts"))
            .cast("double")
            .alias("payment_delay_sec"),
        )
    )


UNPAID_COLUMNS = ("ride_id", "city_id", "terminal_state", "ended_ts", "fare_cents")


def unpaid_rides(
    sessions: DataFrame, payments: DataFrame, bound_sec: int = PAYMENT_BOUND_SEC
) -> DataFrame:
    """Completed rides with no payment inside the bound (batch)."""
    completed = sessions.where(F.col("terminal_state") == "completed")
    paid = ride_payments(completed, payments, bound_sec).select("ride_id").distinct()
    return completed.join(paid, "ride_id", "left_anti").select(*UNPAID_COLUMNS)


def unpaid_rides_stream(
    sessions: DataFrame, payments: DataFrame, bound_sec: int = PAYMENT_BOUND_SEC
) -> DataFrame:
    """The streaming form: a left outer join that emits once the watermark passes the bound."""
    return (
        sessions.alias("s")
        .join(payments.alias("p"), _in_bound(bound_sec), "left_outer")
        .where((F.col("s.terminal_state") == "completed") & F.col("p.txn_id").isNull())
        .select(*[f"s.{c}" for c in UNPAID_COLUMNS])
    )


def left_join_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join of rows unique on ``key`` with rows that may repeat it heavily."""
    matched = left.join(right, key)
    missing = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child key values, with their row counts, that no parent row has; nulls pass."""
    used = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    known = parent.select(F.col(parent_key).alias(child_key))
    return used.join(known, child_key, "left_anti")
