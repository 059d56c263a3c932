"""Slowly changing dimension, type 2, by comparing checked columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scd2_merge(
    history: DataFrame, source: DataFrame, key: str, checked: Sequence[str], run_at: Column
) -> DataFrame:
    """History after a snapshot run.

    ``history`` has the source's columns plus ``valid_from`` and ``valid_to``. A new key opens a
    version at ``run_at``; a change in a checked column closes the open version and opens
    another; an unchanged key keeps its row as it is.
    """
    columns = source.columns
    open_rows = history.where(F.col("valid_to").isNull())
    closed = history.where(F.col("valid_to").isNotNull())
    pairs = (
        open_rows.select(key, F.struct(*open_rows.columns).alias("old"))
        .join(source.select(key, F.struct(*columns).alias("new")), key, "full_outer")
        .withColumn(
            "changed",
            F.col("old").isNotNull()
            & F.col("new").isNotNull()
            & ~reduce(
                lambda a, b: a & b,
                [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in checked],
            ),
        )
    )
    opens = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in columns],
        run_at.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )
    old = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in columns],
        F.col("old.valid_from").alias("valid_from"),
        F.when(F.col("changed"), run_at).alias("valid_to"),
    )
    versions = (
        F.when(F.col("old").isNull(), F.array(opens))
        .when(F.col("changed"), F.array(old, opens))
        .otherwise(F.array(old))
    )
    current = pairs.select(F.inline(versions))
    return closed.select(*current.columns).unionByName(current)


def empty_history(source: DataFrame) -> DataFrame:
    """History before the first run."""
    return source.withColumns(
        {"valid_from": F.lit(None).cast("timestamp"), "valid_to": F.lit(None).cast("timestamp")}
    ).where(F.lit(False))
