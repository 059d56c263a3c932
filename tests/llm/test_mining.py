"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareflow.llm import mining
from tests.llm.cases import clashing

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, n_positives=5, n_negatives=10, low=30, high=90):
    """The definition, over all pairs of rows."""
    known = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            known.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a, (anchor, va, la) in enumerate(known):
        if anchor % 100:
            continue
        scored = [(-sum(map(int.__mul__, va, v)), i, label) for b, (i, v, label) in enumerate(known) if b != a and len(v) == len(va)]
        scored.sort(key=lambda s: s[:2])
        for p, positive in [(-s, i) for s, i, label in scored if label == la][:n_positives]:
            hits = [(i, -s) for s, i, label in scored if label != la and low * p <= -100 * s <= high * p][:n_negatives]
            out += [(anchor, positive, r, i, p, n) for r, (i, n) in enumerate(hits, 1)]
    return sorted(out)


def vectors(seed, n=900, width=6, spread=1.0):
    """Clusters, copies, ties and rows that take no part."""
    draw = random.Random(seed)
    centres = [[draw.gauss(0, spread) for _ in range(width)] for _ in range(7)]
    rows = []
    for i in range(n):
        c = draw.choice(centres)
        rows.append((i, [x + draw.gauss(0, 0.3) for x in c], draw.randrange(4)))
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(60)] + [(700, rows[3][1], 0)] * 3
    rows += [(2000, None, 1), (2100, [1.0] * width, None), (None, [1.0] * width, 1), (2200, [math.nan] * width, 1)]
    rows += [(2300, [None] * width, 1), (2400, [math.inf] + [0.0] * (width - 1), 1), (2500, [0.0] * width, 1), (2600, [], 1), (2700, [], 1)]
    return rows + [(2800, [1.0, 2.0], 1), (2801, [1.0, 2.5], 1), (2802, [1.0, 1.0], 2), (2900, [0.5] * width, 9)]


@pytest.mark.parametrize(("tree_rows", "block_anchors"), [(16_384, 1_024), (50, 3)])
def test_negatives_are_those_of_all_pairs(spark, tree_rows, block_anchors):
    rows = vectors(1)
    table = clashing(spark.createDataFrame(rows, VECTORS))
    found = mining.hard_negatives(table, F.col("vec_id") % 100 == 0, tree_rows=tree_rows, block_anchors=block_anchors)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    wanted = plain(rows)
    assert sorted(map(tuple, found.collect())) == wanted and len({a for a, *_ in wanted}) > 5


def test_awkward_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert mining.hard_negatives(empty, F.col("vec_id") % 100 == 0).count() == 0
    none = spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], VECTORS)
    assert mining.hard_negatives(none, F.col("vec_id") % 100 == 0).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(100, [3e9, 1.0], 0), (1, [2e3, 7.0], 0), (2, [1e3, 0.5], 1), (3, [1e3, 0.25], 1), (4, [3e38, 0.0], 1)]
    found = mining.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0)
    wanted = [r for r in plain(rows) if abs(r[-1]) < 2**63 and abs(r[-2]) < 2**63]
    assert sorted(map(tuple, found.collect())) == wanted and wanted


def test_trees_prune_and_find_the_same(monkeypatch):
    """Boxes bound their points; a search skips leaves and finds what a scan finds."""
    rng = np.random.default_rng(5)
    points = np.floor(256 * (rng.standard_normal((4000, 4)) * 0.1 + rng.integers(-2, 3, (4000, 4))))
    ids = rng.permutation(4000)
    tree = mining.PackedTree(points, ids, np.arange(4000), leaf=32)
    for (lo, hi), below in zip(tree.levels[1:], tree.levels, strict=False):
        for i in range(len(lo)):
            own = slice(i * tree.fan, (i + 1) * tree.fan)
            assert (lo[i] == below[0][own].min(0)).all() and (hi[i] == below[1][own].max(0)).all()
    visited = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            visited.append(len(self))
            return np.asarray(self) @ other

    tree.points = tree.points.view(Counting)
    query = points[0]
    scores = (points @ query).astype(int)
    order = np.lexsort((ids, -scores))
    bounds = [mining.SCORES, (1000, int(scores.max()) // 2)]
    got = tree.search(query, bounds, 10)
    for (low, high), found in zip(bounds, got, strict=True):
        assert found == [(scores[i], ids[i]) for i in order if low <= scores[i] <= high][:10]
    assert sum(visited) < 2000
