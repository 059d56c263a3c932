"""Connected components of links between rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest vertex that each linked vertex can reach: columns ``id`` and ``root``.

    Large-star and small-star rounds. Each vertex hangs its larger neighbours, then its smaller
    ones and itself, on the smallest vertex in sight, until every link leads straight to a
    root; the number of rounds grows with the logarithm of a component's size. No vertex gathers its
    neighbours: minima are aggregated before the shuffle, and joined to links as one row a vertex.
    Each round is written to the shared folder, so a lost executor costs no earlier round. Links of a
    vertex to itself and nulls are left out; an empty table gives an empty table.
    """
    now = links.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).where(f"{a} is not null and {b} is not null and {a} != {b}").distinct()
    now, before = written(now, "links"), None
    while True:
        # Large star: larger neighbours of u go to the smallest of u's neighbours and u.
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: u and its smaller neighbours go to the smallest of them.
        large = written(large.where("u != v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
            )
        before = state


def forest(n: int, a: np.ndarray, b: np.ndarray, roots: np.ndarray | None = None) -> np.ndarray:
    """The smallest vertex of 0 … n - 1 that each reaches by links (a[i], b[i]) and earlier roots."""
    roots = np.arange(n) if roots is None else roots
    while True:
        ra, rb = roots[a], roots[b]
        open_ = ra != rb
        if not open_.any():
            return roots
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(roots, np.maximum(ra, rb), np.minimum(ra, rb))
        while (up := roots[roots]).tobytes() != roots.tobytes():
            roots = up


def star_links(ids: Sequence[int] | np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of all vertices to their roots, in the vertices' own ids."""
    ids, own = np.asarray(ids), np.flatnonzero(roots != np.arange(len(roots)))
    return ids[own], ids[roots[own]]
