"""One row per key: the latest or the earliest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``; end the order with a unique tie-break.

    Spark keeps one row per key in each map task before the shuffle (WindowGroupLimit), so a
    hot key does not travel to one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], *newest: str) -> DataFrame:
    """The row with the greatest ``newest`` columns per key."""
    return first_per_key(df, keys, [F.col(c).desc() for c in newest])
