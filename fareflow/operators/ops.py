"""Operations queries: lag, alerts, rates, audits, throughput."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.times import seconds, slice_of
from fareflow.operators.late import OFFSETS_PER_SLICE
from fareflow.operators.quantiles import exact_quantiles
from fareflow.operators.slices import number_islands, with_previous_row, with_running
from fareflow.schemas import LEGAL_NEXT, TERMINAL_TYPES, WATERMARK_DELAY_SEC


#: How long a series may be silent and still count as going on.
MAX_SAMPLE_GAP_SEC = 300


def resume_offsets(ledger: DataFrame) -> DataFrame:
    """Next offset to read from a ledger of last processed offsets (stored + 1)."""
    return ledger.select(
        "consumer_group", "topic", "partition", (F.col("kafka_offset") + 1).alias("next_offset")
    )


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages behind the end per group and partition, never below zero.

    ``committed`` holds next-to-read offsets; a null or negative one means nothing was ever
    committed and the partition is left out.
    """
    known = committed.where(F.col("next_offset") >= 0)
    return ends.join(known, ["topic", "partition"]).select(
        "consumer_group",
        "topic",
        "partition",
        F.greatest(F.col("end_offset") - F.col("next_offset"), F.lit(0)).alias("lag"),
    )


def sustained(
    samples: DataFrame,
    keys: Sequence[str],
    ts: str,
    breach: Column,
    for_sec: int,
    order: Sequence[str] | None = None,
    slice_sec: int = 3600,
    max_gap_sec: int = MAX_SAMPLE_GAP_SEC,
) -> DataFrame:
    """Runs of consecutive breaching samples per key; ``firing`` once a run lasts ``for_sec``.

    A silence of more than ``max_gap_sec`` between two samples ends a run: a series that is gone breaches nothing.
    """
    marked = samples.withColumn("breach", F.coalesce(breach, F.lit(False)))
    runs = number_islands(
        marked,
        list(keys),
        list(order or [ts]),
        slice_of(F.col(ts), slice_sec),
        [ts, "breach"],
        (F.col("prev.breach") != F.col("breach")) | (F.col(ts) > F.col(f"prev.{ts}") + seconds(max_gap_sec)),
        "run",
    )
    return (
        runs.where("breach")
        .groupBy(*keys, "run")
        .agg(
            F.min(ts).alias("started_at"),
            F.max(ts).alias("last_at"),
            F.count(F.lit(1)).alias("n_samples"),
        )
        .withColumn("firing", F.col("last_at") >= F.col("started_at") + seconds(for_sec))
        .drop("run")
    )


def lag_alerts(samples: DataFrame, limit: int = 1000, for_sec: int = 120, **kwargs) -> DataFrame:
    """Lag strictly above the limit for two minutes, per group, topic and partition."""
    keys = ("consumer_group", "topic", "partition")
    return sustained(samples, keys, "ts", F.col("lag") > limit, for_sec, **kwargs)


def down_alerts(samples: DataFrame, for_sec: int = 120, **kwargs) -> DataFrame:
    """Jobs none of whose targets answered for two minutes."""
    best = samples.groupBy("job", "ts").agg(F.max("up").alias("up"))
    return sustained(best, ("job",), "ts", F.col("up") == 0, for_sec, **kwargs)


def counter_rates(
    samples: DataFrame,
    keys: Sequence[str],
    ts: str,
    counter: str,
    window_sec: int,
    slice_sec: int = 3600,
) -> DataFrame:
    """Increase per second of a counter in fixed windows; a drop means it restarted at zero."""
    rows = with_previous_row(
        samples, keys, [ts], slice_of(F.col(ts), slice_sec), [counter]
    )
    now, before = F.col(counter), F.col(f"prev.{counter}")
    step = F.when(before.isNull(), F.lit(0)).when(now >= before, now - before).otherwise(now)
    return (
        rows.withColumn("_step", step)
        .groupBy(*keys, F.window(ts, f"{window_sec} seconds").alias("w"))
        .agg((F.sum("_step").cast("double") / window_sec).alias("per_second"))
        .select(*keys, F.col("w.start").alias("window_start"), "per_second")
    )


def ledger_audit(expected: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """One row: missing and unexpected ids, and rows against distinct ids of what landed.

    Each side shrinks to one row per id before the two meet.
    """
    want = expected.groupBy(key).agg(F.lit(1).alias("want"))
    have = landed.groupBy(key).agg(F.count(F.lit(1)).alias("have"))
    return want.join(have, key, "full_outer").agg(
        F.count_if(F.col("have").isNull()).alias("n_missing"),
        F.count_if(F.col("want").isNull()).alias("n_unexpected"),
        F.coalesce(F.sum("have"), F.lit(0)).alias("n_rows"),
        F.count("have").alias("n_distinct"),
    )


def lifecycle_violations(
    events: DataFrame,
    arrival: str = "kafka_offset",
    offsets_per_slice: int = OFFSETS_PER_SLICE,
) -> DataFrame:
    """Events that break the lifecycle, judged against the ride's event before in arrival order."""
    rows = with_previous_row(
        events,
        ["ride_id"],
        [arrival],
        F.floor(F.col(arrival) / offsets_per_slice).cast("long"),
        ["event_type", "event_ts"],
    )
    edges = [f"{a}>{b}" for a, following in LEGAL_NEXT.items() for b in following]
    before, kind = F.col("prev.event_type"), F.col("event_type")
    violation = (
        F.when(F.col("prev").isNull() & (kind != "requested"), "first is not requested")
        .when(before.isin(*TERMINAL_TYPES), "after terminal")
        .when(~F.concat_ws(">", before, kind).isin(*edges) & F.col("prev").isNotNull(), "illegal edge")
        .when(F.col("event_ts") < F.col("prev.event_ts"), "time runs back")
    )
    return (
        rows.withColumn("violation", violation)
        .where(F.col("violation").isNotNull())
        .select("ride_id", arrival, "event_type", before.alias("prev_type"), "violation")
    )


def imperfection_profile(
    events: DataFrame,
    malformed: Column,
    skew_sec: int = WATERMARK_DELAY_SEC,
    offsets_per_slice: int = OFFSETS_PER_SLICE,
) -> DataFrame:
    """Per source partition: repeats, reorderings within the skew, late, malformed, null drop-offs."""
    rows = with_running(
        events,
        ["kafka_partition"],
        ["kafka_offset"],
        F.floor(F.col("kafka_offset") / offsets_per_slice).cast("long"),
        F.col("event_ts"),
        "_newest",
        "max",
        inclusive=False,
    )
    behind = F.unix_micros("_newest") - F.unix_micros("event_ts")
    skew = skew_sec * 1_000_000
    measured = rows.groupBy("kafka_partition").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if((behind > 0) & (behind <= skew)).alias("n_out_of_order"),
        F.count_if(behind > skew).alias("n_late"),
        F.count_if(malformed).alias("n_malformed"),
        F.count_if((F.col("event_type") == "requested") & F.col("dropoff_lat").isNull()).alias(
            "n_null_dropoff"
        ),
    )
    repeats = (
        events.groupBy("kafka_partition", "event_id")
        .agg((F.count(F.lit(1)) - 1).alias("n"))
        .groupBy("kafka_partition")
        .agg(F.sum("n").alias("n_duplicate"))
    )
    return measured.join(repeats, "kafka_partition")


def throughput(rows: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per second over the time they span; null for a single moment."""
    span = (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / F.lit(1_000_000.0)
    n = F.count(F.lit(1))
    return rows.groupBy(*keys).agg(
        n.alias("n_rows"),
        span.alias("span_sec"),
        F.try_divide(n, span).alias("rows_per_sec"),
    )


def latency_summary(samples: DataFrame, value: str) -> DataFrame:
    """Median and the sorted value at int(0.95 n) - 1, over all samples, in one run."""
    methods = {"p50_sec": "linear", "p95_sec": "index"}
    return exact_quantiles(samples, (), value, {"p50_sec": 0.5, "p95_sec": 0.95}, methods)
