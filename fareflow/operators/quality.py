"""Data-quality expectations: one aggregation pass per suite."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.schemas import (
    CITY_IDS,
    EVENT_ORDINALS,
    LANDED_EVENT_COLUMNS,
    LAT_BOUNDS,
    LON_BOUNDS,
    SURGE_BOUNDS,
    TERMINAL_STATES,
)

Bound = Column | int | float | None


@dataclass(frozen=True)
class Expectation:
    """A named check on a table or one of its columns.

    ``kind`` is one of columns, not_null, in_set, between, unique, row_count, max_between.
    """

    kind: str
    column: str | None = None
    values: tuple = ()
    low: Bound = None
    high: Bound = None


# Expectation names in the result table; fixed values.
NAMES = {
    "columns": "expect_table_columns_to_match_set",
    "not_null": "expect_column_values_to_not_be_null",
    "in_set": "expect_column_values_to_be_in_set",
    "between": "expect_column_values_to_be_between",
    "unique": "expect_column_values_to_be_unique",
    "row_count": "expect_table_row_count_to_be_between",
    "max_between": "expect_column_max_to_be_between",
}


def _outside(value: Column, low: Bound, high: Bound) -> Column:
    """True when value is known to break a bound; unknown values and open bounds pass."""
    broken = F.lit(False)
    if low is not None:
        broken = broken | F.coalesce(value < low, F.lit(False))
    if high is not None:
        broken = broken | F.coalesce(value > high, F.lit(False))
    return broken


def _violations(e: Expectation) -> Column:
    value = F.col(e.column)
    if e.kind == "not_null":
        return value.isNull()
    if e.kind == "in_set":
        return F.coalesce(~value.isin(*e.values), F.lit(False))
    return _outside(value, e.low, e.high)


def repeated_rows(df: DataFrame, column: str) -> DataFrame:
    """One row: how many rows share their non-null value of ``column`` with another row."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n"))
    )


def run_suite(
    df: DataFrame,
    suite: str,
    expectations: Sequence[Expectation],
    run_id: Column,
    run_at: Column,
    mode: str = "warn",
) -> DataFrame:
    """Result rows of a suite, in the columns of the result table.

    Everything but uniqueness is counted in one pass over the table; each unique column adds
    one keyed count.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, e in enumerate(expectations):
        if e.kind in ("not_null", "in_set", "between"):
            aggs.append(F.count_if(_violations(e)).alias(f"_bad{i}"))
        elif e.kind == "max_between":
            aggs.append(F.max(e.column).alias(f"_max{i}"))
    counted = df.agg(*aggs)
    for i, e in enumerate(expectations):
        if e.kind == "unique":
            counted = counted.withColumn(f"_bad{i}", repeated_rows(df, e.column).scalar())
        # Bounds may be scalar subqueries; as columns they are fetched once.
        if e.kind in ("row_count", "max_between"):
            counted = counted.withColumns(
                {
                    f"_low{i}": e.low if isinstance(e.low, Column) else F.lit(e.low),
                    f"_high{i}": e.high if isinstance(e.high, Column) else F.lit(e.high),
                }
            )
    rows = [_result(df, i, e) for i, e in enumerate(expectations)]
    return counted.select(F.inline(F.array(*rows))).select(
        run_id.alias("run_id"),
        run_at.alias("run_at"),
        F.lit(suite).alias("suite"),
        "expectation",
        "column_name",
        "success",
        "element_count",
        "unexpected_count",
        "observed",
        F.lit(mode).alias("mode"),
    )


def _result(df: DataFrame, i: int, e: Expectation) -> Column:
    no_count = F.lit(None).cast("long")
    elements, unexpected, observed = no_count, no_count, F.lit(None).cast("string")
    if e.kind == "columns":
        success = F.lit(set(df.columns) == set(e.values))
        observed = F.to_json(F.array(*map(F.lit, sorted(df.columns))))
    elif e.kind == "row_count":
        success = ~_outside(F.col("_rows"), F.col(f"_low{i}"), F.col(f"_high{i}"))
        observed = F.col("_rows").cast("string")
    elif e.kind == "max_between":
        top = F.col(f"_max{i}")
        success = top.isNotNull() & ~_outside(top, F.col(f"_low{i}"), F.col(f"_high{i}"))
        observed = F.concat(F.lit('"'), top.cast("string"), F.lit('"'))
    else:
        success = F.col(f"_bad{i}") == 0
        elements, unexpected = F.col("_rows"), F.col(f"_bad{i}")
    return F.struct(
        F.lit(NAMES[e.kind]).alias("expectation"),
        F.lit(e.column).cast("string").alias("column_name"),
        success.alias("success"),
        elements.alias("element_count"),
        unexpected.alias("unexpected_count"),
        observed.alias("observed"),
    )


def landed_events_suite() -> list[Expectation]:
    """Structure and domain of the landed ride events."""
    required = ("ride_id", "event_id", "event_type", "event_ts", "rider_id", "city_id")
    ranges = {
        "pickup_lat": LAT_BOUNDS,
        "pickup_lon": LON_BOUNDS,
        "dropoff_lat": LAT_BOUNDS,
        "dropoff_lon": LON_BOUNDS,
        "fare_cents": (0, None),
        "surge_multiplier": SURGE_BOUNDS,
    }
    return [
        Expectation("columns", values=LANDED_EVENT_COLUMNS),
        *[Expectation("not_null", c) for c in required],
        Expectation("in_set", "event_type", tuple(EVENT_ORDINALS)),
        Expectation("in_set", "city_id", CITY_IDS),
        *[Expectation("between", c, low=low, high=high) for c, (low, high) in ranges.items()],
        Expectation("in_set", "payload_version", (1, 2)),
    ]


def ride_fact_suite(floor: Bound, ceiling: Bound, fresh_since: Column) -> list[Expectation]:
    """Keys, row count and freshness of the ride fact."""
    return [
        Expectation("unique", "ride_id"),
        *[Expectation("not_null", c) for c in ("ride_id", "terminal_state", "requested_at")],
        Expectation("in_set", "terminal_state", TERMINAL_STATES),
        Expectation("row_count", low=floor, high=ceiling),
        Expectation("max_between", "ingested_at", low=fresh_since),
    ]


def row_count_history(results: DataFrame, suite: str, last: int = 10) -> DataFrame:
    """Observed row counts of the last runs, oldest first."""
    return (
        results.where(
            (F.col("suite") == suite)
            & (F.col("expectation") == NAMES["row_count"])
            & F.col("observed").isNotNull()
        )
        .select("run_at", F.expr("try_cast(observed AS bigint)").alias("observed"))
        .orderBy(F.col("run_at").desc())
        .limit(last)
        .where(F.col("observed").isNotNull())
        .orderBy("run_at")
    )


def row_count_bounds(history: DataFrame) -> DataFrame:
    """One row ``floor, ceiling`` from at most ten observed counts; (0, null) without any."""
    middle = F.floor(F.percentile("observed", F.lit(0.5))).cast("long")
    top = F.max("observed")
    return history.agg(
        F.coalesce(top, F.lit(0)).alias("floor"),
        F.when(top.isNotNull(), F.greatest(middle * 4 + 1000, top + 1000)).alias("ceiling"),
    )


def suite_summary(results: DataFrame) -> DataFrame:
    """Passed, failed and pass rate per suite and run; no expectation at all counts as 1.0."""
    return results.groupBy("run_id", "suite").agg(
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.try_divide(F.count_if("success"), F.count("success")), F.lit(1.0)).alias(
            "pass_rate"
        ),
    )


class QualityFailure(RuntimeError):
    """Raised in fail mode when an expectation does not hold."""


def gate(results: DataFrame, mode: str) -> int:
    """Number of failed expectations; raises in ``fail`` mode when there are any."""
    failed = results.where(~F.col("success")).count()
    if failed and mode == "fail":
        raise QualityFailure(f"{failed} expectations failed")
    return failed


# --- invariants: each returns the rows that break it -------------------------------------


def completed_without_duration(rides: DataFrame) -> DataFrame:
    return rides.where(
        (F.col("terminal_state") == "completed")
        & F.col("started_at").isNotNull()
        & (F.col("ride_duration_sec").isNull() | (F.col("ride_duration_sec") <= 0))
    ).select("ride_id", "terminal_state", "started_at", "ride_duration_sec")


def far_future_events(events: DataFrame, now: Column, days: int = 14) -> DataFrame:
    return events.where(F.col("event_at") > now + F.make_dt_interval(days=F.lit(days))).select(
        "event_id", "event_at"
    )


def negative_fares(rides: DataFrame) -> DataFrame:
    return rides.where(F.col("fare_cents") < 0).select("ride_id", "fare_cents")


def payment_fare_mismatch(rides: DataFrame) -> DataFrame:
    return rides.where(
        (F.col("terminal_state") == "completed")
        & (F.col("payment_status") == "completed")
        & ~F.col("paid_amount_cents").eqNullSafe(F.col("fare_cents"))
    ).select("ride_id", "fare_cents", "paid_amount_cents", "payment_status")
