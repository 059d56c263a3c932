"""Ordered per-key computations that survive a hot key.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one task. Here each key
is cut into slices (a time range or an offset range): windows run per (key, slice), so a key spreads over as
many tasks as it has slices, and only one small summary row per slice crosses slice borders. All keys
take the same plan. The slice width is the caller's one choice: the hottest slice must fit one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, SLICE = "_key", "_slice"
PLACE = [KEY, SLICE]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where null matches null; the keys come out once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def _sliced(df: DataFrame, keys: Sequence[str], slice_id: Column) -> DataFrame:
    """The rows by key and slice, in the one exchange that all windows of the branch use.

    The key is a struct, which is not null even where its fields are, so plain equality joins it.
    """
    placed = df.withColumns({KEY: F.struct(*keys), SLICE: F.coalesce(slice_id.cast("long"), F.lit(0))})
    return placed.repartition(*PLACE)


def _in_slice(order: Sequence[str]) -> Window:
    return Window.partitionBy(*PLACE).orderBy(*order)


def _slices_before() -> Window:
    return Window.partitionBy(KEY).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def _slice_before() -> Window:
    return Window.partitionBy(KEY).orderBy(SLICE)


def with_previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_id: Column,
    columns: Sequence[str],
    out: str = "prev",
) -> DataFrame:
    """Add ``out``: a struct of ``columns`` of the row before, per key in ``order``.

    ``slice_id`` must not decrease along ``order``. The struct is null on a key's first row.
    """
    picked = F.struct(*columns)
    placed = df.withColumns({KEY: F.struct(*keys), SLICE: F.coalesce(slice_id.cast("long"), F.lit(0))})
    tails = placed.groupBy(*PLACE).agg(F.max_by(picked, F.struct(*order)).alias("_tail"))
    carried = tails.select(*PLACE, F.lag("_tail").over(_slice_before()).alias("_carried"))
    return (
        _sliced(df, keys, slice_id)
        .join(carried, PLACE, "left")
        .withColumn(out, F.coalesce(F.lag(picked).over(_in_slice(order)), F.col("_carried")))
        .drop("_carried", *PLACE)
    )


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_id: Column,
    value: Column,
    out: str,
    kind: str = "max",
    inclusive: bool = True,
) -> DataFrame:
    """Add ``out``: running ``max`` or ``sum`` of ``value`` per key in ``order``.

    ``inclusive=False`` leaves the row itself out; the result is then null on the first row.
    """
    fold = {"max": F.max, "sum": F.sum}[kind]
    valued = df.withColumn("_value", value)
    placed = valued.withColumns({KEY: F.struct(*keys), SLICE: F.coalesce(slice_id.cast("long"), F.lit(0))})
    totals = placed.groupBy(*PLACE).agg(fold("_value").alias("_total"))
    carried = totals.select(*PLACE, fold("_total").over(_slices_before()).alias("_carried"))
    until = Window.currentRow if inclusive else -1
    local, carry = F.col("_local"), F.col("_carried")
    if kind == "max":
        combined = F.greatest(local, carry)
    else:
        combined = F.when(
            local.isNotNull() | carry.isNotNull(),
            F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0)),
        )
    return (
        _sliced(valued, keys, slice_id)
        .join(carried, PLACE, "left")
        .withColumn("_local", fold("_value").over(_in_slice(order).rowsBetween(Window.unboundedPreceding, until)))
        .withColumn(out, combined)
        .drop("_local", "_carried", "_value", *PLACE)
    )


def number_islands(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_id: Column,
    carry: Sequence[str],
    starts_new: Column,
    out: str = "island",
) -> DataFrame:
    """Gaps and islands: number each key's runs 1, 2, … and flag the rows that open one.

    ``starts_new`` is a condition over the row's ``order`` and ``carry`` columns and over ``prev`` (a struct of
    the ``carry`` columns of the row before). A key's first row always opens an island. Adds ``prev``, ``is_new``
    (0/1) and ``out``.

    Inside a slice every row but the first knows the row before it. A slice's summary is its first and last row
    and how many islands the others open; along the key's summaries follow what comes before each slice and
    how many islands were opened until then.
    """
    picked, opens = F.struct(*carry), F.when(F.col("prev").isNull() | starts_new, 1).otherwise(0)
    needed = list(dict.fromkeys([*order, *carry]))
    at = F.struct(*order)

    narrow = _sliced(df.select(*dict.fromkeys([*keys, *needed])), keys, slice_id)
    flagged = narrow.withColumn("prev", F.lag(picked).over(_in_slice(order)))
    summaries = flagged.groupBy(*PLACE).agg(
        F.min_by(F.struct(*needed), at).alias("_first"),
        F.max_by(picked, at).alias("_tail"),
        F.sum(F.when(F.col("prev").isNotNull(), opens).otherwise(0)).alias("_rest"),
    )
    chained = summaries.withColumn("prev", F.lag("_tail").over(_slice_before()))
    opened = chained.select(*PLACE, "prev", "_rest", "_first.*").withColumn("_opened", F.col("_rest") + opens)
    before = opened.select(
        *PLACE,
        F.col("prev").alias("_carried"),
        F.coalesce(F.sum("_opened").over(_slices_before()), F.lit(0)).alias("_base"),
    )
    within = _in_slice(order)
    return (
        _sliced(df, keys, slice_id)
        .join(before, PLACE, "left")
        .withColumn("prev", F.coalesce(F.lag(picked).over(within), F.col("_carried")))
        .withColumn("is_new", opens)
        .withColumn(out, F.col("_base") + F.sum("is_new").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .drop("_carried", "_base", *PLACE)
    )


def islands_in_slices(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_id: Column,
    carry: Sequence[str],
    starts_new: Column,
) -> DataFrame:
    """The first half of islands that are folded: every slice by itself, in one exchange of the rows.

    Adds ``prev`` (as in ``number_islands``, null on a slice's first row), ``is_last`` (of its slice) and ``part``: how many
    islands opened in the slice after its first row. Rows of one ``part`` of a slice are one island, but for its ends.
    """
    within = _in_slice(order)
    opens = F.when(F.col("prev").isNotNull() & starts_new, 1).otherwise(0)
    return (
        _sliced(df, keys, slice_id)
        .withColumns({"prev": F.lag(F.struct(*carry)).over(within), "is_last": F.lead(F.lit(1)).over(within).isNull()})
        .withColumn("part", F.sum(opens).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )


def chain_islands(parts: DataFrame, starts_new: Column) -> DataFrame:
    """The second half: number the islands of folded parts along each key, 1, 2, …

    ``parts`` has a row for each key, slice and ``part``, with structs ``first`` of a slice's first row (on part 0) and ``tail``
    of its last (on its last part). Adds ``island`` and, on a part 0 that goes on with the island of the slice before, ``prev``: its tail.
    Only one row a slice is ordered along its key.
    """
    opens = F.when(F.col("prev").isNull() | starts_new, 1).otherwise(0)
    summaries = parts.groupBy(*PLACE).agg(
        F.min_by("first", "part").alias("_first"), F.max_by("tail", "part").alias("_tail"), F.max("part").alias("_rest")
    )
    chained = summaries.withColumn("prev", F.lag("_tail").over(_slice_before()))
    first = chained.select(*PLACE, "prev", "_rest", "_first.*").withColumn("_opens", opens)
    opened = first.withColumn("_opened", F.col("_opens") + F.col("_rest"))
    before = opened.select(
        *PLACE,
        F.when(F.col("_opens") == 0, F.col("prev")).alias("_carried"),
        (F.col("_opens") + F.coalesce(F.sum("_opened").over(_slices_before()), F.lit(0))).alias("_base"),
    )
    return (
        parts.join(before, PLACE, "left")
        .withColumn("prev", F.when(F.col("part") == 0, F.col("_carried")))
        .withColumn("island", F.col("_base") + F.col("part"))
        .drop("_carried", "_base")
    )
