"""Shards of near-equal size by sampled splitters.

Rows are ordered by a hash of their text, so equal texts lie together. A sample of keys, drawn with chances in
proportion to size, gives quantile boundaries for many fine ranges; exact sums then show what each range holds. A range
above its share (a text with very many copies) is subdivided by id. Consecutive ranges are dealt to the
shards by the bytes that come before them, so a shard misses its share by one range at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, text_key, written

#: Fine ranges a shard has on average, and sampled keys a range.
RANGES_A_SHARD = 64
SAMPLES_A_RANGE = 32


def size_of(text: str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def chance(key: Column, salt: Column) -> Column:
    """A number in [0, 1) that only the row decides."""
    return F.pmod(F.xxhash64(key, salt), F.lit(1 << 52)) / float(1 << 52)


def splitters(slim: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Boundaries of ``ranges`` key ranges: quantiles of keys drawn with chances in proportion to size.

    About ``ranges * SAMPLES_A_RANGE`` rows are drawn, whatever the table; a row as large as several draws is
    worth that many. Repeated rows share one draw, and a range that this makes too large is subdivided.
    """
    draws = ranges * SAMPLES_A_RANGE
    worth = F.col("size") * draws / total
    picked = slim.where(chance(F.col("key"), F.col("salt")) < worth).select(
        "key", F.greatest(worth, F.lit(1.0)).alias("worth")
    )
    found = picked.groupBy("key").agg(F.sum("worth").alias("worth")).toPandas().sort_values("key")
    if found.empty:
        return np.zeros(0, np.int64)
    upto = found["worth"].cumsum().to_numpy()
    wanted = upto[-1] * np.arange(1, ranges) / ranges
    return np.unique(found["key"].to_numpy()[np.searchsorted(upto, wanted)])


def range_of(key: Column, boundaries: np.ndarray) -> Column:
    """Number of boundaries below the key."""

    @F.pandas_udf("int")
    def found(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in keys:
            yield pd.Series(np.searchsorted(boundaries, batch.to_numpy()).astype(np.int32))

    return found(key)


def plan(spark: SparkSession, slim: DataFrame, boundaries: np.ndarray, total: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """Exact sums of the ranges, and where each of their pieces goes.

    Returns (range, pieces) and (range, piece, shard, base): a row for each of the ranges and pieces, of which there
    are at most ``2 * shards * RANGES_A_SHARD``.
    """
    ranges = shards * RANGES_A_SHARD
    share = max(1, total // ranges)
    sums = slim.groupBy("range").agg(F.sum("size").alias("bytes")).toPandas()
    sums["pieces"] = np.where(sums["bytes"] > 2 * share, -(-sums["bytes"] // share), 1)
    pieces = spark.createDataFrame(sums[["range", "pieces"]], "range int, pieces long")
    cut = slim.join(F.broadcast(pieces), "range").withColumn("piece", piece_of())
    found = cut.groupBy("range", "piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toPandas()
    found = found.sort_values(["range", "piece"])
    middle = found["bytes"].cumsum() - found["bytes"] / 2
    found["shard"] = np.minimum(shards - 1, (middle * shards // total)).astype(np.int32)
    found["base"] = found["rows"].groupby(found["shard"]).cumsum() - found["rows"]
    homes = spark.createDataFrame(
        found[["range", "piece", "shard", "base"]], "range int, piece long, shard int, base long"
    )
    return pieces, homes


def piece_of() -> Column:
    """Piece of a row in its range, by a hash of its id; ranges in one piece have piece 0."""
    return F.pmod(F.xxhash64("salt", "key"), F.col("pieces"))


def with_shards(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", by: str = "bytes"
) -> DataFrame:
    """``docs`` with ``size`` (bytes of the text plus 1), ``law``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    The law is ``bytes``: sizes near equal. Rows with equal texts share a shard but where a range had to be
    subdivided or ends between them. A null text has size 1, apart from the empty text's key. A row is never split, so one
    larger than a shard's share fills its shard beyond it. Repeated rows have slots of their own; which of two
    rows alike has which is undefined. An empty table stays empty. Columns of ``docs`` named like a new
    one (in any case) are replaced.
    """
    if by != "bytes":
        raise ValueError("the only law here is bytes")
    spark = docs.sparkSession
    new = ["size", "law", "shard", "slot"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new and c not in (id_col, text_col)])
    salt = F.xxhash64(F.col(id_col).cast("string"))
    keyed = docs.select(text_key(text_col).alias("key"), salt.alias("salt"), size_of(text_col).alias("size"))
    slim = written(keyed, "shard-keys")
    total = slim.agg(F.sum("size")).first()[0] or 1
    boundaries = splitters(slim, total, shards * RANGES_A_SHARD)
    pieces, homes = plan(spark, slim.withColumn("range", range_of(F.col("key"), boundaries)), boundaries, total, shards)

    names = ["key", "salt", "range", "pieces", "piece", "base"]
    inner = free_name(docs, [f"_shard_{n}" for n in names])
    key, salt_, range_, pieces_, piece, base = inner
    rows = docs.withColumns({key: text_key(text_col), salt_: salt, "size": size_of(text_col)})
    rows = rows.withColumn(range_, range_of(F.col(key), boundaries))
    rows = rows.join(F.broadcast(pieces.withColumnsRenamed({"range": range_, "pieces": pieces_})), range_)
    rows = rows.withColumn(piece, F.pmod(F.xxhash64(salt_, key), F.col(pieces_)))
    renamed = homes.withColumnsRenamed({"range": range_, "piece": piece, "base": base})
    rows = rows.join(F.broadcast(renamed), [range_, piece])
    in_piece = Window.partitionBy(range_, piece).orderBy(key, salt_)
    slot = F.row_number().over(in_piece) - 1 + F.col(base)
    return rows.withColumns({"slot": slot.cast("long"), "law": F.lit(by)}).select(*docs.columns, *new)


def write_shards(docs: DataFrame, folder: str, shards: int = 8, **options: str) -> None:
    """Write each shard as a folder of Parquet files whose rows follow its slots."""
    placed = with_shards(docs, shards, **options)
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
