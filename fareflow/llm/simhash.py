"""SimHash near-duplicates: fingerprints, and exact neighbours by a vantage-point tree.

The tree. A vantage point is one fingerprint of the data. A fingerprint's distance to it is
measured on each quarter of the bits, which adds up to the Hamming distance; so for two
fingerprints within ``radius``, the differences of their four distances sum to ``radius`` at most
(the triangle inequality, quarter by quarter). Level k of the tree branches by the distance on quarter k.
Consecutive leaves are gathered into shards of bounded size, and a shard meets each shard whose
bounds lie within ``radius`` of its own. Inside a pair of shards the leaves are pruned in the same way, and
the rest is compared bit by bit. No pair within the radius is lost, and there is no cap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, written
from fareflow.llm.graph import components, forest, star_links

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
QUARTERS = 4
SIDE = 64 // QUARTERS + 1
#: Hashes whose bits are counted at a time.
BITS_AT_ONCE = 1 << 18


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The 64 bits that are set in over half the XXH64 hashes (seed 42) of a text's shingles."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for i in range(0, n, BITS_AT_ONCE):
        spans = zip(starts[i : i + BITS_AT_ONCE], ends[i : i + BITS_AT_ONCE], strict=True)
        hashes = np.array([digest(line[a:b], 42) for a, b in spans], dtype="<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """Per row: id and ``fp``, the fingerprint as a signed 64-bit number; null texts are empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["id", "fp"])

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    read = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    return read.mapInArrow(hashed, f"id {dict(read.dtypes)['id']}, fp long")


def distances(fp: Column, vantage: int) -> list[Column]:
    """Distance to the vantage point on each quarter of the bits, the lowest first."""
    width = SIDE - 1
    differing = fp.bitwiseXOR(F.lit(vantage))
    return [
        F.bit_count(F.shiftrightunsigned(differing, width * q).bitwiseAND(F.lit((1 << width) - 1)))
        for q in range(QUARTERS)
    ]


def leaf_numbers(fp: np.ndarray, vantage: int, quarters: int) -> np.ndarray:
    """Distances on the first quarters as one row per fingerprint."""
    differing = (fp ^ np.int64(vantage)).view(np.uint16).reshape(-1, QUARTERS)
    return np.bitwise_count(differing[:, :quarters]).astype(np.int64)


def near_links(
    left: np.ndarray, right: np.ndarray, vantage: int, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of all fingerprints of the two sides within ``radius``, a leaf at a time."""
    levels = 3
    scale = SIDE ** np.arange(levels)

    def leaves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        own = leaf_numbers(fp, vantage, levels)
        code = own @ scale
        order = np.argsort(code, kind="stable")
        _, starts = np.unique(code[order], return_index=True)
        return order, starts, np.append(starts[1:], len(fp)), own[order[starts]]

    a_order, a_from, a_to, a_leaf = leaves(left)
    b_order, b_from, b_to, b_leaf = leaves(right)
    a, b = left[a_order].view(np.uint64), right[b_order].view(np.uint64)
    for lo, hi, leaf in zip(a_from, a_to, a_leaf, strict=True):
        close = np.flatnonzero(np.abs(b_leaf - leaf).sum(axis=1) <= radius)
        if not len(close):
            continue
        sizes = b_to[close] - b_from[close]
        at = np.arange(sizes.sum()) + np.repeat(b_from[close] - (np.cumsum(sizes) - sizes), sizes)
        others = b[at]
        step = max(1, 4_000_000 // len(others))
        for i in range(lo, hi, step):
            x, y = np.nonzero(np.bitwise_count(a[i : min(hi, i + step), None] ^ others[None, :]) <= radius)
            if len(x):
                yield a_order[i + x], b_order[at[y]]


def shard_plan(cells: pd.DataFrame, shard_rows: int, radius: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Leaves to shards, and the pairs of shards that the radius can bridge.

    ``cells``: one row per leaf (columns q0 … and n), at most 17^4. A leaf above ``shard_rows`` gets several
    shards (``pieces``); smaller ones share one.
    """
    qs = [f"q{i}" for i in range(QUARTERS)]
    cells = cells.sort_values(qs).reset_index(drop=True)
    pieces = np.maximum(1, -(-cells["n"].to_numpy() // shard_rows))
    first, shard, room = [], -1, 0
    for n, k in zip(cells["n"], pieces, strict=True):
        if k > 1 or n > room:
            first.append(shard + 1)
            shard += int(k)
            room = shard_rows - n if k == 1 else 0
        else:
            first.append(shard)
            room -= n
    cells["shard"], cells["pieces"] = first, pieces
    whole = cells.loc[cells.index.repeat(cells["pieces"])]
    number = whole["shard"] + whole.groupby(level=0).cumcount()
    lo = whole[qs].groupby(number).min().to_numpy()
    hi = whole[qs].groupby(number).max().to_numpy()
    pairs = []
    for i in range(len(lo)):
        gap = np.maximum(0, np.maximum(lo[i] - hi[i:], lo[i:] - hi[i])).sum(axis=1)
        pairs += [(i, i + int(j)) for j in np.flatnonzero(gap <= radius)]
    return cells, pd.DataFrame(pairs, columns=["a", "b"])


def near_fingerprints(prints: DataFrame, radius: int = 4, shard_scale: int = 64) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``radius``; a forest for each pair of shards.

    ``prints`` has one row per fingerprint (``fp``). Of n fingerprints a shard holds ``shard_scale * sqrt(n)``, so
    the size of a pair of shards and the number of copies each fingerprint is dealt in both
    grow as the root of n. The leaves, at most 17^4, and the pairs, n / shard_scale^2 at most, are what the driver plans with.
    """
    spark = prints.sparkSession
    links = "a long, b long"
    n, vantage = prints.agg(F.count("*"), F.min_by("fp", F.xxhash64("fp"))).first()
    if not n:
        return spark.createDataFrame([], links)
    placed = prints.select("fp", *[d.alias(f"q{i}") for i, d in enumerate(distances(F.col("fp"), vantage))])
    qs = [f"q{i}" for i in range(QUARTERS)]
    cells = placed.groupBy(*qs).agg(F.count("*").alias("n")).toPandas()
    cells, pairs = shard_plan(cells, math.ceil(shard_scale * math.sqrt(n)), radius)
    plan = spark.createDataFrame(cells[[*qs, "shard", "pieces"]])
    pair_rows = spark.createDataFrame(pairs.reset_index(names="pair"))
    ends = pair_rows.select("pair", F.col("a").alias("shard"), F.lit(0).alias("side")).union(
        pair_rows.where("a != b").select("pair", F.col("b").alias("shard"), F.lit(1).alias("side"))
    )
    # Leaves and pairs are small by the bounds above; fingerprints are dealt to the pairs of their shard.
    sharded = placed.join(F.broadcast(plan), qs).select(
        "fp", (F.col("shard") + F.pmod(F.xxhash64("fp"), F.col("pieces"))).cast("long").alias("shard")
    )
    dealt = sharded.join(F.broadcast(ends), "shard").select("pair", "side", "fp")

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        fp, side = rows["fp"].to_numpy(), rows["side"].to_numpy()
        order = np.argsort(side, kind="stable")
        fp, right = fp[order], int((side == 0).sum())
        two = right < len(fp)
        roots = np.arange(len(fp))
        for i, j in near_links(fp[:right], fp[right:] if two else fp, vantage, radius):
            roots = forest(len(fp), i, j + right if two else j, roots)
        a, b = star_links(fp, roots)
        return pd.DataFrame({"a": a, "b": b})

    return dealt.groupBy("pair").applyInPandas(linked, links)


def near_duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """Per row: id, ``fp``, ``fingerprint`` (16 hex digits) and ``component_id``.

    Words are what stands between ASCII white space, A-Z lower-cased; a text of fewer words than a
    shingle is one shingle, and a text without words (null, empty, blank) has fingerprint zero and is linked
    like any other. ``component_id`` is the smallest id reachable by links of at most ``radius`` bits;
    null ids are reached but never the smallest. Equal texts share a fingerprint and cost one vertex.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    links = near_fingerprints(distinct.select("fp"), radius)
    roots = components(links)
    rooted = distinct.join(roots.withColumnRenamed("id", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col),
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is their group's ``component_id``, repeated rows once.

    A group whose ids are all null keeps its null rows, one for each text.
    """
    groups = near_duplicate_groups(docs, id_col, text_col)
    key, name = free_name(docs, ["_text_key", "_kept"])
    keep = groups.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias(name)).distinct()
    kept = docs.join(keep, F.col(id_col).eqNullSafe(F.col(name)), "left_semi")
    return kept.withColumn(key, F.xxhash64(text_col)).dropDuplicates([id_col, key]).drop(key)
