"""Mixtures and shards of awkward tables."""

from __future__ import annotations

from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from fareflow.llm import mixing, shards
from tests.llm.cases import clashing, documents, prose


def mixed_blocks(spark, sizes, weights, rest, block_rows):
    rows = [(i, "t", "x", s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    found = mixing.mix(documents(spark, rows), weights, rest, block_rows=block_rows, cell_rows=7).collect()
    assert sorted(r.doc_id for r in found) == [r[0] for r in rows]
    return found


def test_every_source_is_within_a_block_of_its_share(spark):
    weights, rest = {"a": 5, "b": 3, "c": 1}, 2
    sizes = {"a": 63, "b": 200, "c": 41, "d": 30, None: 9}
    found = mixed_blocks(spark, sizes, weights, rest, block_rows=4)
    blocks = {(r.grp, r.block): r for r in found}
    slots = sorted((r.slot, r.grp) for r in blocks.values())
    assert [s for s, _ in slots] == list(range(len(slots)))  # one block to a slot, none empty
    # While all sources last (whole rounds), each is less than one block off its weight.
    rounds = min(-(-sizes[g] // 4) // w for g, w in weights.items())
    rounds = min(rounds, -(-39 // 4) // rest)
    total, seen = 11, Counter()
    for slot, grp in slots[: rounds * total]:
        seen[grp] += 1
        for g, w in [*weights.items(), (mixing.REST, rest)]:
            assert abs(seen[g] - Fraction(w * (slot + 1), total)) < 1
    # Each block runs inside its window, counted from its round's first slot.
    base = {}
    for r in blocks.values():
        w = {**weights, mixing.REST: rest}[r.grp]
        base.setdefault(r.block // w, []).append(r)
    first = 0
    for number in sorted(base):
        for r in base[number]:
            assert first + r.release <= r.slot < first + r.deadline
        first += len(base[number])
    # Blocks are full but for a source's last one.
    rows = Counter((r.grp, r.block) for r in found)
    last = {g: max(b for h, b in rows if h == g) for g, _ in rows}
    assert all(n == 4 or b == last[g] for (g, b), n in rows.items())


def test_awkward_rows_are_all_placed(spark):
    docs = documents(spark)
    found = mixing.mix(clashing(docs), {"src0": 2, "src1": 1}, block_rows=3)
    assert found.count() == docs.count()
    assert {r.grp for r in found.collect()} == {"src0", "src1", mixing.REST}
    assert mixing.mix(docs.limit(0), {"src0": 2}).count() == 0
    assert mixing.in_mixed_order(docs, {"src0": 2}).columns == docs.columns
    for bad in ({"a": 0}, {"a": mixing.MOST_SLOTS}):
        with pytest.raises(ValueError):
            mixing.mix(docs, bad)


def test_written_rows_follow_the_mixture(spark, folder):
    docs = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    slots = {r.doc_id: (r.slot, r.row_in_block) for r in mixing.mix(docs, {"src0": 1}, block_rows=2).collect()}
    mixing.in_mixed_order(docs, {"src0": 1}, block_rows=2).write.parquet(f"{folder}/m")
    read = spark.read.parquet(f"{folder}/m").selectExpr("doc_id", "_metadata.file_name f", "_metadata.row_index r")
    order = [slots[r.doc_id][0] for r in read.orderBy("f", "r").collect()]
    assert order == sorted(order)


def check_shards(found, n_rows, n=8):
    assert len(found) == n_rows
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by.values())
    assert set(by) <= set(range(n))
    return {s: sum(r.size for r in own) for s, own in by.items()}


def test_shards_are_near_equal_and_keep_equal_texts_together(spark):
    rows = [(i, prose(i, 20 + i % 90), "x", "s") for i in range(4000)] + [(9000 + i, prose(3, 50), "x", "s") for i in range(20)]
    found = shards.with_shards(documents(spark, rows)).collect()
    sizes = check_shards(found, len(rows))
    mean = sum(sizes.values()) / 8
    assert max(sizes.values()) < 1.03 * mean and min(sizes.values()) > 0.97 * mean
    texts = defaultdict(set)
    for r in found:
        texts[r.text].add(r.shard)
    assert sum(len(s) > 1 for s in texts.values()) <= 1


def test_a_text_with_a_third_of_all_rows_is_subdivided(spark):
    rows = [(i, prose(i, 30), "x", "s") for i in range(2000)] + [(5000 + i, prose(1, 30), "x", "s") for i in range(1000)]
    sizes = check_shards(shards.with_shards(documents(spark, rows)).collect(), 3000)
    assert max(sizes.values()) < 1.1 * sum(sizes.values()) / 8


def test_awkward_rows_have_shards(spark, folder):
    docs = documents(spark)
    found = shards.with_shards(clashing(docs)).collect()
    check_shards(found, docs.count())
    assert all(r.size == (1 if r.text is None else len(r.text.encode()) + 1) for r in found)
    assert shards.with_shards(docs.limit(0)).count() == 0
    shards.write_shards(docs, f"{folder}/s")
    assert spark.read.parquet(f"{folder}/s").count() == docs.count()
    with pytest.raises(ValueError):
        shards.with_shards(docs, by="rows")
