"""Epoch-millisecond and whole-second time expressions (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with milliseconds and the ``+00:00`` offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")


def whole_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end, fraction cut off."""
    return F.timestamp_diff("SECOND", start, end)


def elapsed_sec(end: Column, start: Column) -> Column:
    """Seconds between two millisecond times, never below zero, null if either is null."""
    gap = (F.unix_millis(end) - F.unix_millis(start)) / F.lit(1000.0)
    # greatest() skips nulls, so the guard keeps an unknown time unknown.
    return F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0)))


def seconds(n: int) -> Column:
    """An interval literal of n seconds; a literal lets stream joins bound their state."""
    return F.expr(f"INTERVAL '{n}' SECOND")


def slice_of(ts: Column, width_sec: int) -> Column:
    """Number of the fixed-width time slice holding ``ts``."""
    return F.floor(F.unix_micros(ts) / F.lit(width_sec * 1_000_000)).cast("long")
