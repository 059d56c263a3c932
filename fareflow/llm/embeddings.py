"""Near-duplicate vectors: p-stable hashing for Euclidean distance, then exact cosines.

A table's hash is ``functions`` quantised projections floor((a·v + b) / width) of the normalised vector, with a drawn
from a normal distribution (which is 2-stable) and b from [0, width). Vectors with cosine c lie
sqrt(2 - 2c) apart; at c = 0.95 one projection agrees with probability 0.874 for width 2, a table of ten with 0.26, and
one of 32 tables with 0.99993. Vectors that meet in a table are compared by their exact cosine.

Equal vectors are one class and are hashed once. Buckets are cut into blocks of bounded size; a pair of blocks is
one unit of work, so a crowded bucket spreads over many tasks and loses no pair. A pair that meets in several
tables counts in the first of them alone. Work units give counts and a spanning forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import written
from fareflow.llm.graph import components, forest, star_links

#: Pairs compared at a time in small buckets.
PAIRS_AT_ONCE = 100_000
#: Buckets up to this size are compared pair by pair, larger ones by matrix products.
SMALL = 96
#: What 32-bit products may be off by before the exact comparison.
SLACK = 1e-4


@dataclass(frozen=True)
class Hashing:
    """``tables`` hash tables of ``functions`` projections each, drawn from ``seed``."""

    tables: int = 32
    functions: int = 10
    width: float = 2.0
    seed: int = 7

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """Bucket of each normalised vector in each table: (vectors, tables)."""
        rng = np.random.default_rng([self.seed, unit.shape[1]])
        n = self.tables * self.functions
        directions, shifts = rng.standard_normal((unit.shape[1], n)), rng.uniform(0, self.width, n)
        mixing = rng.integers(-(2**62), 2**62, self.functions) | 1
        cells = np.floor((unit @ directions + shifts) / self.width).astype(np.int64)
        return (cells.reshape(len(unit), self.tables, self.functions) * mixing).sum(axis=2)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as a matrix of doubles."""
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def normalised(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def comparable(vector: str) -> Column:
    """Whether a vector has a direction: components that are numbers, one of them not zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def ragged_pairs(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows i < j of each group [start, end), about PAIRS_AT_ONCE at a time."""
    rows = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends, strict=True)])
    partners = np.repeat(ends, ends - starts) - rows - 1
    upto = np.cumsum(partners)
    i = 0
    while i < len(rows):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] - partners[i] + PAIRS_AT_ONCE, side="right")))
        n = partners[i:j]
        left = np.repeat(rows[i:j], n)
        yield left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        i = j


def close_pairs(
    unit: np.ndarray, group: np.ndarray, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the same group (sorted) whose vectors have a cosine of ``threshold`` or more."""
    small = unit.astype(np.float32)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    ends = np.append(starts[1:], len(group))
    few = ends - starts <= SMALL

    def exact(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sure = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
        return i[sure], j[sure]

    if few.any():
        for i, j in ragged_pairs(starts[few], ends[few]):
            near = np.einsum("ij,ij->i", small[i], small[j]) >= threshold - SLACK
            yield exact(i[near], j[near])
    for a, b in zip(starts[~few], ends[~few], strict=True):
        step = max(1, 2_000_000 // (b - a))
        for k in range(a, b, step):
            i, j = np.nonzero(small[k : min(b, k + step)] @ small[a:b].T >= threshold - SLACK)
            i, j = i + k, j + a
            for m in range(0, len(i), PAIRS_AT_ONCE):
                x, y = i[m : m + PAIRS_AT_ONCE], j[m : m + PAIRS_AT_ONCE]
                yield exact(x[x < y], y[x < y])


def complete_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches' rows again, cut so that no group (first column, sorted) is parted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(0).to_numpy()
        cut = int(np.searchsorted(group, group[-1]))
        if cut or (held and held[-1].column(0)[-1].as_py() != group[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def linked_classes(classes: DataFrame, threshold: float, hashing: Hashing, block_rows: int) -> DataFrame:
    """Per unit of work: rows (a, b, n): ``n`` rows are linked to class a, or a and b are connected (n null).

    ``classes``: cls, copies, vector; written, so that ``cls`` stays what it is.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.arange(hashing.tables, dtype=np.int32)
        for batch in batches:
            widths = batch.column(1).value_lengths().to_numpy()
            for width in np.unique(widths):
                own = batch.filter(pa.array(widths == width))
                found = hashing.buckets(normalised(matrix(own.column(1)))) ^ width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own.column(0).to_numpy(), hashing.tables)),
                        pa.array(np.tile(tables, len(own))),
                        pa.array(found.ravel()),
                    ],
                    ["cls", "tab", "bucket"],
                )

    met = written(classes.select("cls", "vector").mapInArrow(hashed, "cls long, tab int, bucket long"), "buckets")
    sizes = met.groupBy("tab", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    placed = met.join(sizes, ["tab", "bucket"]).withColumn("blocks", blocks).withColumn("own", own)
    units = placed.select("cls", "tab", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    unit = F.xxhash64("tab", "bucket", F.least("own", "other"), F.greatest("own", "other"))
    dealt = units.select(unit.alias("unit"), "tab", "own", "cls").join(classes, "cls")
    grouped = dealt.select("unit", "tab", "own", "cls", "copies", "vector").repartition("unit").sortWithinPartitions("unit")

    def compared(table: pa.Table) -> pa.RecordBatch:
        """Counts and forest of whole units of work whose vectors have one length."""
        group, tab, side, cls, copies = (table.column(i).to_numpy() for i in range(5))
        unit = normalised(matrix(table.column(5).combine_chunks()))
        # Units of two blocks compare across them only.
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        mixed = np.minimum.reduceat(side, starts) != np.maximum.reduceat(side, starts)
        two = np.repeat(mixed, np.diff(np.append(starts, len(group))))
        buckets, n, roots = None, np.zeros(len(group), np.int64), np.arange(len(group))
        for i, j in close_pairs(unit, group, threshold):
            across = ~two[i] | (side[i] != side[j])
            i, j = i[across], j[across]
            if not len(i):
                continue
            roots = forest(len(group), i, j, roots)
            buckets = hashing.buckets(unit) if buckets is None else buckets
            for earlier in range(hashing.tables):
                new = (tab[i] <= earlier) | (buckets[i, earlier] != buckets[j, earlier])
                i, j = i[new], j[new]
            np.add.at(n, i, copies[j])
            np.add.at(n, j, copies[i])
        a, b = star_links(cls, roots)
        some = np.flatnonzero(n)
        columns = [
            pa.array(np.concatenate([cls[some], a])),
            pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(b)]),
            pa.concat_arrays([pa.array(n[some]), pa.nulls(len(a), pa.int64())]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "n"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_groups(batches):
            widths = pc.list_value_length(table.column(5))
            for width in pc.unique(widths).to_pylist():
                yield compared(table.filter(pc.equal(widths, width)).combine_chunks())

    return written(grouped.mapInArrow(linked, "a long, b long, n long"), "vector-links")


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    hashing: Hashing | None = None,
    block_rows: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row: id, n_links, component_id (smallest id reachable by links), kept (id = component_id).

    Rows link if their cosine, in double precision, is ``threshold`` or more and they meet in a table. A
    vector that is null, empty or zero, or has a null or non-finite component, links with nothing, not even with
    its copies. Equal vectors always link. Vectors of different lengths never do. A null id can be
    linked but is nobody's component; without any id in its component it is its own (null, kept). Classes
    are told apart by a 128-bit hash of the vector.
    """
    key = [F.xxhash64(vector_col).alias("h1"), F.xxhash64(F.lit(1), F.col(vector_col)).alias("h2")]
    rows = vectors.select(F.col(id_col).alias("id"), comparable(vector_col).alias("ok"), *key, F.col(vector_col).alias("vector"))
    grouped = rows.where("ok").groupBy("h1", "h2").agg(
        F.count("*").alias("copies"), F.min("id").alias("least"), F.first("vector").alias("vector")
    )
    classes = written(grouped.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    links = linked_classes(classes.select("cls", "copies", "vector"), threshold, hashing or Hashing(), block_rows)
    counts = links.where("n is not null").groupBy("a").agg(F.sum("n").alias("others"))
    roots = components(links.where("b is not null").select("a", "b"))
    known = classes.select("h1", "h2", "cls", "copies", "least")
    known = known.join(counts, known["cls"] == counts["a"], "left").drop("a")
    known = known.join(roots, known["cls"] == roots["id"], "left").drop("id").withColumn("root", F.coalesce("root", "cls"))
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    named = known.join(least, "root").select(
        "h1", "h2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component"
    )
    slim = rows.select("id", "ok", "h1", "h2")
    alone = slim.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    result = slim.where("ok").join(named, ["h1", "h2"]).select("id", "n_links", "component").union(alone)
    return result.select(
        F.col("id").alias(id_col),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
