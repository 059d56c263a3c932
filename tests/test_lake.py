from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators import upsert
from fareflow.sources.versions import VersionedTable
from fareflow.sources.lake import Lake
from fareflow.sources.versions import KeyedTable, RowCountChanged
from tests.rides import T0, event, events_df

DAY = 86_400_000


def batch(spark, *rides, version=1, day=0, **extra):
    return events_df(spark, [event("requested", T0 + day * DAY, r, payload_version=version, **extra) for r in rides])


def test_snapshots_evolution_and_time_travel(spark, folder):
    lake = Lake(spark, folder)
    assert lake.read().count() == 0
    assert lake.append(batch(spark, "a", "b"), "1") == 1
    assert "promo_code" not in lake.read().columns
    assert lake.append(batch(spark, "c", version=2, promo_code="SAVE5", day=1), "2") == 2
    rows = lake.read()
    assert rows.count() == 3 and rows.where("promo_code IS NULL").count() == 2
    old = lake.read(1)
    assert old.count() == 2 and "promo_code" not in old.columns
    assert lake.append(batch(spark, "d"), "3") == 3
    assert lake.read().count() == 4 and "promo_code" in lake.read().columns
    assert rows.where("is_synthetic").count() == 3, "a DataFrame stays on the snapshot it was made from"


def test_replayed_and_unfinished_batches(spark, folder):
    lake = Lake(spark, folder)
    lake.append(batch(spark, "a"), "1")
    assert lake.append(batch(spark, "a"), "1") is None
    # Files written, writer lost before the commit: invisible, and the replay overwrites them.
    lake._write(batch(spark, "x", "y").withColumns({"is_synthetic": F.lit(True), "event_day": F.to_date("event_ts")}), "2")
    assert lake.read().count() == 1
    lake.append(batch(spark, "x"), "2")
    assert sorted(r["ride_id"] for r in lake.read().collect()) == ["a", "x"]
    assert lake.append(batch(spark), "3") is None
    assert lake.append(batch(spark, "z"), "4") == 3


def test_compaction(spark, folder):
    lake = Lake(spark, folder)
    for n in range(5):
        lake.append(batch(spark, f"r{n}"), str(n))
    lake.append(batch(spark, "other", city_id=2), "other")
    rows = sorted(r["ride_id"] for r in lake.read().collect())
    dry = lake.compact(dry_run=True)
    assert (dry.partitions_total, dry.partitions_compacted, dry.files_before_total) == (2, 0, 6)
    assert lake.compact(min_files=5).partitions_compacted == 0
    done = lake.compact()
    assert (done.partitions_compacted, done.files_before_total, done.files_after_total) == (1, 6, 2)
    assert sorted(r["ride_id"] for r in lake.read().collect()) == rows
    stats = {r["city_id"]: (r["files"], r["rows"]) for r in lake.inventory().collect()}
    assert stats == {1: (1, 5), 2: (1, 1)}
    assert lake.compact().partitions_compacted == 0
    assert lake.read(3).count() == 3, "snapshots from before stay readable"
    lake.append(batch(spark, "later"), "later")
    assert lake.read().count() == 7


def test_compaction_refuses_lost_rows(spark, folder):
    lake = Lake(spark, folder)
    for n in range(5):
        lake.append(batch(spark, f"r{n}"), str(n))
    # Overwrite one batch's files behind the ledger's back with one row more than it knows of.
    lake._write(batch(spark, "r4", "r5").withColumns({"is_synthetic": F.lit(True), "event_day": F.to_date("event_ts")}), "4")
    with pytest.raises(RowCountChanged):
        lake.compact()
    assert lake.state()[0] == 5


SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("day", T.StringType())])


def test_keyed_table_moves_keys_and_leaves_other_partitions(spark, folder):
    table = KeyedTable(spark, folder, SCHEMA, ["day"], ["k"])
    order = [F.col("v").desc()]
    table.insert(spark.createDataFrame([("a", 1, "d1"), ("b", 1, "d2"), ("c", 1, "d3")], SCHEMA), "1", order)
    table.insert(spark.createDataFrame([("a", 9, "d1"), ("d", 1, "d3")], SCHEMA), "2", order)
    combine = lambda old, new: upsert.upsert_last(old, new, ["k"], order)
    table.merge(spark.createDataFrame([("a", 2, "d2")], SCHEMA), "3", combine)
    assert sorted(map(tuple, table.read().collect())) == [("a", 2, "d2"), ("b", 1, "d2"), ("c", 1, "d3"), ("d", 1, "d3")]
    assert {r["day"] for r in table.entries().where("snapshot = 3").collect()} == {"d1", "d2"}
    assert table.merge(spark.createDataFrame([("a", 3, "d2")], SCHEMA), "3", combine) is None
    assert table.read(2).where("k = 'a'").first()["v"] == 1


def test_null_partition_values_are_kept(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, p string")
    table = VersionedTable(spark, f"{folder}/t", rows.schema, ["p"])
    table.append(rows, "one")
    assert sorted(r["k"] for r in table.read().collect()) == [1, 2, 3]
    table.rewrite(rows.where("p is null").select("p"), lambda old: old.withColumn("k", F.col("k") * 10), "two")
    assert sorted(r["k"] for r in table.read().collect()) == [1, 3, 20]
    table.append(rows.where("p is null"), "three")
    table.compact(min_files=1)
    assert sorted(r["k"] for r in table.read().collect()) == [1, 2, 3, 20]


def test_a_read_opens_live_batches_only(spark, folder):
    rows = spark.createDataFrame([(1, "a")], "k int, p string")
    table = VersionedTable(spark, f"{folder}/t", rows.schema, ["p"])
    table.append(rows, "first")
    for n in range(4):
        table.rewrite(rows.select("p"), lambda old: old, f"again-{n}")
    data = [f for f in table.read().inputFiles() if "/data/" in f]
    assert data and all("batch=again-3" in f for f in data)


def test_expiry_keeps_what_is_asked_for(spark, folder):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    table = VersionedTable(spark, f"{folder}/t", rows.schema, ["p"])
    table.append(rows, "first")
    for n in range(3):
        table.rewrite(rows.select("p"), lambda old: old.withColumn("k", F.col("k") + 1), f"again-{n}")
    assert table.expire(keep=[2]) == 2
    assert table.expire(keep=[2]) == 0
    assert [sorted(r["k"] for r in table.read(s).collect()) for s in (2, 4, None)] == [[2, 3], [4, 5], [4, 5]]
    with pytest.raises(AnalysisException):
        table.read(1).collect()
