"""Mixing sources to target weights by Pfair scheduling.

Each source's rows form blocks of equal size. With weight w out of W, block i of a source has the
release time floor(i W / w) and the deadline ceil((i + 1) W / w); slots take the released block with the earliest
deadline. Every block then meets its window, so at any slot each source is less than one block off
its share.

The windows repeat after W slots, a round, in which each source has w blocks. Sources run dry: once one has
fewer than w blocks left, that round gives it those as its weight, and later rounds none. So there are only
a few kinds of rounds (two for each source), the same schedule serves all rounds of a kind, and a block's slot
follows from its number alone. All rows are placed; none is repeated or dropped.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, parts_for

#: Largest sum of the weights (slots in a round) and number of weighted sources; bounds the schedule.
MOST_SLOTS = 1_000
MOST_SOURCES = 100
REST = "(rest)"
#: Columns that ``mix`` adds.
NEW = ("grp", "block", "row_in_block", "release", "deadline", "slot")
#: Leading hex digits of the draw that name a cell, and so the largest number of cells of a source.
CELL_DIGITS = 4
CELLS = 16**CELL_DIGITS
#: Production weights, in hundredths: the large crawl, the curated sources, the others, and what has no weight.
TARGETS = {"src0": 20} | {f"src{i}": 5 for i in range(1, 10)} | {f"src{i}": 3 for i in range(10, 20)}
REST_TARGET = 5


def group_of(source: str, weights: Mapping[str, int]) -> Column:
    """The source if it has a weight of its own, REST otherwise (null included)."""
    return F.when(F.col(source).isin(*weights), F.col(source)).otherwise(F.lit(REST))


def earliest_deadline_first(parts: Column) -> Column:
    """Schedule of one round: an array of (grp, i, release, deadline, slot).

    ``parts``: array of (grp, n), n blocks of each group in the round; the round has sum(n) slots.
    """
    total = F.aggregate(parts, F.lit(0), lambda a, p: a + p["n"])
    sized = F.transform(parts, lambda p: F.struct(p["grp"].alias("grp"), p["n"].alias("n"), total.alias("all")))
    blocks = F.flatten(
        F.transform(
            F.filter(sized, lambda p: p["n"] > 0),
            lambda p: F.transform(
                F.sequence(F.lit(0), p["n"] - 1),
                lambda i: F.struct(
                    F.ceil((i + 1) * p["all"] / p["n"]).cast("int").alias("deadline"),
                    F.floor(i * p["all"] / p["n"]).cast("int").alias("release"),
                    p["grp"].alias("grp"),
                    i.cast("int").alias("i"),
                ),
            ),
        )
    )
    empty = F.array().cast("array<struct<deadline:int,release:int,grp:string,i:int,slot:int>>")

    def take(state: Column, slot: Column) -> Column:
        ready = F.filter(state["left"], lambda b: b["release"] <= slot)
        pick = F.array_min(ready)  # structs compare by deadline, then release and group
        placed = F.struct(*[pick[c].alias(c) for c in ("deadline", "release", "grp", "i")], slot.alias("slot"))
        return F.struct(
            F.array_remove(state["left"], pick).alias("left"),
            F.concat(state["done"], F.array(placed)).alias("done"),
        )

    slots = F.when(total > 0, F.sequence(F.lit(0), total - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(slots, F.struct(blocks.alias("left"), empty.alias("done")), take, lambda s: s["done"])


def schedule(blocks: DataFrame, weights: DataFrame) -> DataFrame:
    """Slots of all kinds of rounds: from_round, to_round, base, per_round, deadline, release, grp, i, slot.

    ``blocks``: grp, blocks (how many there are). ``weights``: grp, w. Both have a row per group at most.
    """
    each = F.collect_list(F.struct("grp", "w", "blocks"))  # one small row of at most MOST_SOURCES + 1 groups
    groups = blocks.join(weights, "grp").agg(F.array_sort(each).alias("groups"))
    whole = F.transform("groups", lambda g: F.floor(g["blocks"] / g["w"]))
    cuts = F.array_sort(F.array_distinct(F.flatten(F.array(F.array(F.lit(0).cast("long")), whole, F.transform(whole, lambda r: r + 1)))))
    bounds = F.transform("cuts", lambda c, k: F.struct(c.alias("from_round"), F.get("cuts", k + 1).alias("to_round")))
    kinds = groups.select("groups", cuts.alias("cuts")).select("groups", F.explode(bounds).alias("r")).select("groups", "r.*")
    since = F.col("from_round")
    parts = F.transform(
        "groups",
        lambda g: F.struct(
            g["grp"].alias("grp"),
            F.greatest(F.lit(0), F.least(g["w"].cast("long"), g["blocks"] - since * g["w"])).cast("int").alias("n"),
        ),
    )
    base = F.aggregate("groups", F.lit(0).cast("long"), lambda a, g: a + F.least(g["blocks"], since * g["w"]))
    planned = kinds.select("from_round", "to_round", base.alias("base"), parts.alias("parts"))
    per_round = F.aggregate("parts", F.lit(0), lambda a, p: a + p["n"])
    slots = F.explode(earliest_deadline_first(F.col("parts"))).alias("s")
    return planned.select("from_round", "to_round", "base", per_round.alias("per_round"), slots).select(
        "from_round", "to_round", "base", "per_round", "s.*"
    )


def mix(
    docs: DataFrame,
    weights: Mapping[str, int],
    rest_weight: int = 1,
    block_rows: int = 64,
    seed: int = 0,
    cell_rows: int = 2_000,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with columns grp, block, row_in_block, release, deadline and slot (in blocks).

    ``weights`` are whole numbers; sources without one, and null, share ``rest_weight``. A source's rows
    are taken in an order drawn by ``seed`` (the md5 of seed and id; ties by a hash of the text; rows alike in
    both cannot be told apart), ``block_rows`` to a block; its last block may have fewer. Release and
    deadline count slots from the round's first. Every row comes out once; an empty table stays empty. Columns of
    ``docs`` named like a new one (in any case) are replaced.

    Rows are numbered inside cells, ranges of the drawn order of one source that hold about ``cell_rows`` rows each,
    so that no source is ordered by one task.
    """
    total = sum(weights.values()) + rest_weight
    if not all(w > 0 for w in [*weights.values(), rest_weight]) or total > MOST_SLOTS or len(weights) > MOST_SOURCES:
        raise ValueError(f"weights must be positive and sum to {MOST_SLOTS} at most, for {MOST_SOURCES} sources at most")
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() in NEW and c not in (id_col, source_col, text_col)])
    cells = min(CELLS, parts_for(docs.count(), cell_rows))
    draw, tie, cell, before, at, round_, i, plan_grp, plan_i, plan = free_name(
        docs, ["_draw", "_tie", "_cell", "_before", "_at", "_round", "_i", "_plan_grp", "_plan_i", "_plan"]
    )
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary"))
    # The cell is the leading part of the draw, so cells follow one another in its order.
    number = F.conv(F.substring(drawn, 1, CELL_DIGITS), 16, 10).cast("long")
    rows = docs.withColumns(
        {
            "grp": group_of(source_col, weights),
            draw: drawn,
            tie: F.xxhash64(text_col),
            cell: F.floor(number * cells / CELLS),
        }
    )
    counts = rows.groupBy("grp", cell).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("grp").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("grp", cell, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    sizes = counts.groupBy("grp").agg(F.ceil(F.sum("n") / block_rows).alias("blocks"))
    pairs = [*weights.items(), (REST, rest_weight)]
    slots = schedule(sizes, spark.createDataFrame(pairs, "grp string, w int"))
    kinds = slots.select(F.col("grp").alias(plan_grp), F.col("i").alias(plan_i), F.struct("*").alias(plan))

    # The join with a cell's offset and the numbering inside the cell use one exchange of the rows.
    in_cell = Window.partitionBy("grp", cell).orderBy(draw, tie)
    placed = rows.join(offsets, ["grp", cell]).withColumn(at, F.row_number().over(in_cell) - 1 + F.col(before))
    weight = F.element_at(F.create_map(*[F.lit(x) for p in pairs for x in p]), F.col("grp"))
    blocked = placed.withColumns(
        {"block": F.floor(F.col(at) / block_rows), "row_in_block": (F.col(at) % block_rows).cast("int")}
    ).withColumns({round_: F.floor(F.col("block") / weight), i: (F.col("block") % weight).cast("int")})
    of_kind = F.col(round_) >= F.col(f"{plan}.from_round")
    of_kind &= F.col(f"{plan}.to_round").isNull() | (F.col(round_) < F.col(f"{plan}.to_round"))
    same = (F.col("grp") == F.col(plan_grp)) & (F.col(i) == F.col(plan_i)) & of_kind
    # At most 2 MOST_SOURCES + 3 kinds of rounds of MOST_SLOTS slots.
    slotted = blocked.join(F.broadcast(kinds), same)
    since = F.col(round_) - F.col(f"{plan}.from_round")
    slot = F.col(f"{plan}.base") + since * F.col(f"{plan}.per_round") + F.col(f"{plan}.slot")
    return slotted.withColumns(
        {"release": F.col(f"{plan}.release"), "deadline": F.col(f"{plan}.deadline"), "slot": slot}
    ).select(*docs.columns, *NEW)


def in_mixed_order(docs: DataFrame, weights: Mapping[str, int], **options: object) -> DataFrame:
    """The rows of ``docs`` range-partitioned and sorted by slot, so that written files follow the mixture.

    Columns named like one of ``mix``'s stay what they are.
    """
    own = {options.get(c, d) for c, d in (("id_col", "doc_id"), ("source_col", "source"), ("text_col", "text"))}
    clashing = [c for c in docs.columns if c.lower() in NEW and c not in own]
    away = dict(zip(clashing, free_name(docs, [f"_{c}" for c in clashing]), strict=True))
    mixed = mix(docs.withColumnsRenamed(away), weights, **options)
    ordered = mixed.repartitionByRange("slot", "row_in_block").sortWithinPartitions("slot", "row_in_block")
    return ordered.select(*[F.col(away.get(c, c)).alias(c) for c in docs.columns])
