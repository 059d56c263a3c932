"""Hard-negative mining by inner product over STR-packed R-trees.

Rows are sorted and tiled (sort-tile-recursive): Spark deals them in ranges of label and first coordinate, a range is
cut into trees of one label and bounded size, and a tree's rows are sorted by one coordinate after another into
leaves of equal size. A node's minimum bounding box gives each coordinate's smallest and largest product with a query, and so an
interval of inner products. The search takes the box with the largest possible score first; a box is left out if its
interval misses every score window, or lies strictly below the k-th score of every window it meets.

Anchors are the queries, in blocks, against all trees: a block and a tree are one unit of work of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import parts_for, written

#: Rows of a leaf, children of a node, rows of a tree, anchors of a block.
LEAF, FAN, TREE_ROWS, BLOCK_ANCHORS = 256, 8, 16_384, 1_024
#: Bits of a row's number that count the rows of its task.
ROW_BITS = 40

#: Scores that a long holds.
SCORES = (-(2**63), 2**63 - 1)

Hit = tuple[int, int]


def str_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Rows in sort-tile-recursive order, coordinates of large variance first; each ``leaf`` of them are a leaf."""
    axes = np.argsort(-points.astype(float).var(axis=0), kind="stable")

    def tiled(rows: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        pages = -(-len(rows) // leaf)
        if pages <= 1 or depth == len(axes):
            yield rows
            return
        rows = rows[np.argsort(points[rows, axes[depth]], kind="stable")]
        slabs = int(np.ceil(pages ** (1 / (len(axes) - depth)) - 1e-9))
        size = leaf * -(-pages // slabs)
        for start in range(0, len(rows), size):
            yield from tiled(rows[start : start + size], depth + 1)

    return np.concatenate(list(tiled(np.arange(len(points)), 0)))


class PackedTree:
    """An R-tree of points, packed; points are whole numbers, and scores are exact."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> None:
        order = str_order(points, leaf)
        self.points, self.ids, self.rows = points[order], ids[order], rows[order]
        self.leaf, self.fan = leaf, fan
        starts = np.arange(0, len(points), leaf)
        self.levels = [(np.minimum.reduceat(self.points, starts), np.maximum.reduceat(self.points, starts))]
        while len(self.levels[-1][0]) > 1:
            lo, hi = self.levels[-1]
            starts = np.arange(0, len(lo), fan)
            self.levels.append((np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts)))
        self.largest = max(-min(0, self.levels[-1][0].min(initial=0)), self.levels[-1][1].max(initial=0))

    def search(self, query: np.ndarray, windows: Sequence[tuple[int, int]], k: int, own_row: int = -1) -> list[list[Hit]]:
        """The first ``k`` (score, id) within each window [low, high], by score downwards, then by id; ``own_row`` is left out."""
        points, query = self.exact(query)
        plus, minus = np.maximum(query, 0), np.minimum(query, 0)
        floors, highs = np.array([w[0] for w in windows]), np.array([w[1] for w in windows])
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        queue: list[tuple[float, int, int, float, float]] = []

        def push(level: int, start: int, end: int) -> None:
            lo, hi = (box[start:end].astype(points.dtype, copy=False) for box in self.levels[level])
            upper, lower = hi @ plus + lo @ minus, lo @ plus + hi @ minus
            wanted = ((upper[:, None] >= floors) & (lower[:, None] <= highs)).any(axis=1)
            for i in np.flatnonzero(wanted).tolist():
                heapq.heappush(queue, (-min(upper[i], top), level, start + i, upper[i], lower[i]))

        top = max(highs)
        push(len(self.levels) - 1, 0, 1)
        while queue:
            most, level, node, upper, lower = heapq.heappop(queue)
            if -most < floors.min():
                break
            if not ((upper >= floors) & (lower <= highs)).any():
                continue
            if level:
                push(level - 1, node * self.fan, min((node + 1) * self.fan, len(self.levels[level - 1][0])))
                continue
            rows = slice(node * self.leaf, (node + 1) * self.leaf)
            scores, others = points[rows] @ query, self.rows[rows] != own_row
            for j in range(len(windows)):
                hits = np.flatnonzero((scores >= floors[j]) & (scores <= highs[j]) & others)
                if len(hits):
                    new = zip((-scores[hits]).tolist(), self.ids[rows][hits].tolist(), strict=True)
                    best[j] = sorted([*best[j], *new])[:k]
                    if len(best[j]) == k:
                        floors[j] = max(floors[j], -best[j][-1][0])
        return [[(int(-score), i) for score, i in own] for own in best]

    def exact(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points and query as doubles where all sums are exact in them, else as Python's whole numbers."""
        size = float(np.abs(query).max(initial=0)) * float(self.largest) * max(1, len(query))
        if size < 2.0**52:
            return self.points, query
        whole = np.frompyfunc(int, 1, 1)
        return whole(self.points).astype(object), whole(query).astype(object)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1 if len(lists.flatten()) else 0)


def finite(vector: str) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def treed(rows: DataFrame, scale: float, tree_rows: int) -> DataFrame:
    """``rows`` (id, label, anchor, vector) dealt to trees of one label and one length: adds row, part, tree, point.

    A component becomes floor(scale * x); a row in which that is not finite takes no part.
    """
    by = ["label", "size", "first", "id"]
    ranges = rows.withColumns({"size": F.size("vector"), "first": F.get("vector", F.lit(0)).cast("double")})
    ranges = ranges.repartitionByRange(*by).sortWithinPartitions(*by)

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        row = tree = part << ROW_BITS
        n, before = 0, None
        for batch in batches:
            lists, sizes = batch.column(3), batch.column(3).value_lengths().to_numpy()
            # A product beyond the doubles is infinite, and its row goes.
            with np.errstate(over="ignore"):
                flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            bad = np.append(0, np.cumsum(~np.isfinite(flat)))
            ends = np.cumsum(sizes)
            keep = bad[ends] == bad[ends - sizes]
            trees, keys = [], zip(batch.column(1).to_pylist(), sizes.tolist(), strict=True)
            for kept, key in zip(keep.tolist(), keys, strict=True):
                if kept and (key != before or n == tree_rows):
                    tree, n, before = tree + 1, 0, key
                n += kept
                trees.append(tree)
            offsets = pa.array(np.append(0, ends).astype(np.int32))
            points = pa.ListArray.from_arrays(offsets, pa.array(flat))
            columns = [
                *(batch.column(i) for i in range(3)),
                pa.array(row + np.arange(len(batch))),
                pa.array(np.full(len(batch), part, np.int32)),
                pa.array(np.array(trees, np.int64)),
                points,
            ]
            row += len(batch)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    kinds = dict(rows.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, anchor boolean, row long, part int, tree long, point array<double>"
    names = [part.split()[0] for part in schema.split(", ")]
    return ranges.select("id", "label", "anchor", "vector").mapInArrow(dealt, schema)


def searched(
    rows: DataFrame, anchors: DataFrame, units: DataFrame, meets: str, task: Callable[[PackedTree, dict], Iterator[tuple]], schema: str
) -> DataFrame:
    """``task`` of each anchor with each tree of its block's units that it meets (a condition on both)."""

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(left) and len(right):
            tree = PackedTree(matrix(left["point"]), left["id"].to_numpy(), left["row"].to_numpy())
            for anchor in right.rename_columns([c.removeprefix("anchor_") for c in right.column_names]).to_pylist():
                anchor["point"] = np.array(anchor["point"], np.float64)
                found += task(tree, anchor)
        columns = zip(*found, strict=True) if found else [[] for _ in out]
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, out.types, strict=True)], schema=out)

    out = pa.schema([(part.split()[0], {"long": pa.int64(), "int": pa.int32()}[part.split()[1]]) for part in schema.split(", ")])
    left = rows.select("tree", "id", "row", "point").join(units.select("tree", "block"), "tree").groupBy("tree", "block")
    right = anchors.join(units, "block").where(meets).drop("label", "size", "own", "own_size", "part")
    # Names of their own tell the two sides apart, which come from the same rows.
    right = right.select(*[F.col(c).alias(f"anchor_{c}") for c in right.columns]).groupBy("anchor_tree", "anchor_block")
    return left.cogroup(right).applyInArrow(search, schema)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    tree_rows: int = TREE_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """Per anchor and positive the first negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of whole numbers floor(scale * x). An anchor (a row for which ``anchor`` holds) has as positives the first
    ``n_positives`` other rows of its label, by score downwards, ties by smaller id. Negatives are rows of other labels whose score,
    times 100, lies between ``window`` times the positive's; the first ``n_negatives`` are returned, ranks from 1.

    Rows with a null id or label, or a vector that is null or has a null or non-finite component (also once scaled), take no
    part. Vectors of different lengths never meet. Repeated rows are rows each: a copy of an anchor is an anchor and an other
    row. An anchor without positives, or a positive without negatives, gives no row; neither does an empty table. Pairs
    whose score a long cannot hold do not count.
    """
    known = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite(vector_col)
    rows = vectors.where(known).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).alias("vector"),
    )
    rows = written(treed(rows, scale, tree_rows), "mining-rows")
    queries = rows.where("anchor").select("row", "id", "label", F.size("point").alias("size"), "point")
    n_blocks = parts_for(queries.count(), block_anchors)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int"))
    trees = written(rows.groupBy("part", "tree").agg(F.first("label").alias("label"), F.first(F.size("point")).alias("size")), "mining-trees")
    def first(found: DataFrame, per: list[str], name: str, n: int) -> DataFrame:
        order = Window.partitionBy(*per).orderBy(F.col(f"{name}_score").desc(), f"{name}_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    def positives(tree: PackedTree, query: dict) -> Iterator[tuple]:
        (found,) = tree.search(query["point"], [SCORES], n_positives, query["row"])
        return ((query["row"], query["id"], score, i) for score, i in found)

    own = queries.select("label", "size", "block").distinct()
    near = searched(
        rows,
        queries.select("block", "row", "id", "point", F.col("label").alias("own"), F.col("size").alias("own_size")),
        trees.join(own, ["label", "size"]), "own = label and own_size = size",
        positives, "row long, anchor_id long, positive_score long, positive_id long",
    )
    near = written(first(near, ["row"], "positive", n_positives).withColumnRenamed("rank", "nth"), "positives")

    def negatives(tree: PackedTree, query: dict) -> Iterator[tuple]:
        bounds = [(-(-window[0] * w["positive_score"] // 100), window[1] * w["positive_score"] // 100) for w in query["wins"]]
        bounds = [(max(low, SCORES[0]), min(high, SCORES[1])) for low, high in bounds]
        for win, found in zip(query["wins"], tree.search(query["point"], bounds, n_negatives), strict=True):
            yield from ((query["row"], win["nth"], score, i) for score, i in found)

    wins = near.groupBy("row").agg(F.collect_list(F.struct("nth", "positive_score")).alias("wins"))
    far = searched(
        rows,
        queries.join(wins, "row").select("block", "row", "point", "wins", F.col("label").alias("own"), F.col("size").alias("own_size")),
        trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))), "own != label and own_size = size",
        negatives, "row long, nth int, negative_score long, negative_id long",
    )
    far = first(far, ["row", "nth"], "negative", n_negatives)
    return far.join(near, ["row", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
