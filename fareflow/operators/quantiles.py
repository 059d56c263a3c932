"""Exact quantiles and histogram quantiles without holding a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.operators.slices import null_safe_join, with_running

#: A sketch's ranks are off by a share of 1 / ACCURACY at most; brackets reach MARGIN times as far on either side.
ACCURACY, MARGIN = 10_000, 4


def _ranks(q: float, total: Column, method: str) -> tuple[Column, Column, Column]:
    """Lower rank, upper rank and weight of the upper value, ranks counted from 0."""
    if method == "linear":
        position = F.lit(float(q)) * (total - 1)
        lower = F.floor(position).cast("long")
        return lower, F.ceil(position).cast("long"), position - lower
    index = F.greatest(F.floor(F.lit(float(q)) * total).cast("long") - 1, F.lit(0))
    return index, index, F.lit(0.0)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    method: str | Mapping[str, str] = "linear",
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per key group with the named quantiles of the non-null values, all in one run.

    ``linear`` interpolates between neighbours (percentile_cont); ``index`` takes the sorted value at
    ``int(q * n) - 1``; a mapping names the method of each quantile. No width of bins has to be guessed: a first pass
    draws a sketch of each group, whose ranks are off by n / ``accuracy`` at most, and takes from it a bracket around
    each quantile. A second pass counts the values outside the brackets, span by span, and the distinct values inside, both on the
    map side; running sums over those find the ranks, one task a bracket. Values that are all alike are one row.
    """
    grouped = [F.col(k) for k in keys] if keys else [F.lit(0).alias("_all")]
    names = list(keys) if keys else ["_all"]
    methods = dict.fromkeys(quantiles, method) if isinstance(method, str) else method
    values = df.where(F.col(value).isNotNull()).select(*grouped, F.col(value).cast("double").alias("_v"))
    shares = [min(max(q + d / accuracy, 0.0), 1.0) for q in quantiles.values() for d in (-MARGIN, MARGIN)]
    brackets = values.groupBy(*names).agg(
        F.count(F.lit(1)).alias("_total"), F.percentile_approx("_v", shares, accuracy).alias("_edges")
    )
    edges = [F.col("_edges")[i] for i in range(len(shares))]
    inside = reduce(lambda a, b: a | b, [F.col("_v").between(lo, hi) for lo, hi in zip(edges[::2], edges[1::2], strict=True)])
    span = reduce(lambda a, b: a + b, [(F.col("_v") > edge).cast("int") for edge in edges])
    if keys:
        placed = null_safe_join(values, brackets, names, "inner")
    else:
        placed = values.withColumns({c: brackets.select(c).scalar() for c in ("_total", "_edges")})
    cells = (
        placed.select(*names, "_total", span.alias("_span"), F.when(inside, F.col("_v")).alias("_one"), "_v")
        .groupBy(*names, "_total", "_span", "_one")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    )
    ranked = with_running(cells, names, ["_least"], F.col("_span"), F.col("_n"), "_upto", "sum")
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1

    def at(rank: Column) -> Column:
        """The value at a rank: a cell's only value, or, next to a bracket, the end of a span."""
        own = F.when(rank == first, F.col("_least")).when((rank == last) | F.col("_one").isNotNull(), F.col("_most"))
        return F.max(F.when((rank >= first) & (rank <= last), own))

    ranks = {n: _ranks(q, F.col("_total"), methods[n]) for n, q in quantiles.items()}
    picks = [at(rank).alias(f"_{end}_{n}") for n, (lo, hi, _) in ranks.items() for end, rank in (("lo", lo), ("hi", hi))]
    picked = ranked.groupBy(*names).agg(F.max("_total").alias("_total"), *picks)
    return picked.select(
        *keys,
        *[
            (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * weight).alias(name)
            for name, (_, _, weight) in ranks.items()
        ],
        F.col("_total").alias("n_values"),
    )


def histogram_quantiles(
    hist: DataFrame,
    keys: Sequence[str],
    bucket: str,
    count: str,
    quantiles: Mapping[str, float],
    width: float,
    total: str,
) -> DataFrame:
    """Upper edge of the first bucket whose running count reaches ``ceil(q * n)``."""
    per_key = Window.partitionBy(*keys)
    running = F.sum(count).over(per_key.orderBy(bucket))
    cume = hist.withColumn("_cum", running).withColumn("_total", F.sum(count).over(per_key))
    edge = (F.col(bucket) + 1) * F.lit(float(width))
    return cume.groupBy(*keys).agg(
        *[
            F.min(F.when(F.col("_cum") >= F.ceil(F.lit(q) * F.col("_total")), edge)).alias(name)
            for name, q in quantiles.items()
        ],
        F.max("_total").alias(total),
    )


def bucket_quantile(
    buckets: DataFrame, keys: Sequence[str], le: str, cumulative: str, q: float, out: str
) -> DataFrame:
    """Quantile of cumulative ``le`` buckets, interpolated inside the bucket that holds it.

    The open-ended bucket (``le`` infinite) answers with the highest finite edge.
    """
    ordered = Window.partitionBy(*keys).orderBy(le)
    rows = buckets.select(
        *keys,
        F.col(le).alias("_le"),
        F.col(cumulative).cast("double").alias("_cum"),
        F.lag(le, 1, 0.0).over(ordered).alias("_low"),
        F.lag(F.col(cumulative).cast("double"), 1, 0.0).over(ordered).alias("_before"),
        F.max(F.col(cumulative).cast("double")).over(Window.partitionBy(*keys)).alias("_total"),
    )
    rank = F.lit(q) * F.col("_total")
    holds = (F.col("_cum") >= rank) & (F.col("_before") < rank)
    share = (rank - F.col("_before")) / (F.col("_cum") - F.col("_before"))
    inner = F.when(F.col("_le") == F.lit(float("inf")), F.col("_low")).otherwise(
        F.col("_low") + (F.col("_le") - F.col("_low")) * share
    )
    return rows.groupBy(*keys).agg(F.max(F.when(holds, inner)).alias(out))
