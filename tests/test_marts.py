"""What a run of the marts reads: each input is parsed once, pings are folded in one pass, a merge opens touched days only."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from fareflow.checks import streams
from fareflow.operators.shifts import driver_shifts, joined_shifts, numbered_shifts, shift_parts
from fareflow.plans import marts
from fareflow.plans.build import MartStore
from fareflow.sources.derived import DriverTables
from fareflow.sources.versions import KeyedTable, VersionedTable
from tests.rides import collect
from tests.test_stream_batches import counted

ORDER = ("ts", "ping_id")


def tables(spark, folder, n=400):
    """Events of a few users over 30 days, some of them in the last ones only."""
    pick, start = random.Random(3), dt.datetime(2024, 1, 1)
    kinds = ("signup", "view", "click", "purchase", "error")
    rows = [
        (i, start + dt.timedelta(seconds=i * 30 * 86_400 // n, milliseconds=pick.randrange(1000)), pick.randrange(40), pick.choice(kinds),
         pick.randrange(9000) / 100, f'{{"k": {pick.randrange(100)}}}')
        for i in range(n)
    ]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.write.parquet(f"{folder}/events.parquet")
    return DriverTables(spark, folder)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_runs_read_what_has_landed(spark, folder, monkeypatch):
    t, seen, run = tables(spark, folder), [], MartStore.run

    def noted(self, *args, **more):
        seen.append([executed(df) for df in args[2:5]])
        return run(self, *args, **more)

    monkeypatch.setattr(MartStore, "run", noted)
    built = streams._marts(t)
    assert len(seen) == 2 and not any("get_json_object" in text or "events.parquet" in text for texts in seen for text in texts)
    fact = built.fct_rides
    enriched = marts.enriched_rides(
        marts.stage_sessions(marts.with_ingest_time(t.sessions, F.lit("2024-01-31").cast("timestamp"))),
        marts.stage_payments(t.payments),
        marts.dim_cities(t.cities),
    )
    names = [c for c in marts.FACT_COLUMNS if c != "ingested_at"]
    assert sorted(map(repr, fact.select(names).collect())) == sorted(map(repr, enriched.select(names).collect()))
    want = driver_shifts(t.pings, ORDER)
    assert sorted(map(repr, built.fct_driver_shifts.drop("distance_km").collect())) == sorted(map(repr, want.drop("distance_km").collect()))


def test_a_run_reads_each_ping_once_for_its_shifts(spark, folder):
    t = tables(spark, f"{folder}/in")
    pings, times = counted(spark, t.pings, "lat")
    sessions = marts.with_ingest_time(t.sessions, F.lit("2024-02-01").cast("timestamp"))
    MartStore(spark, f"{folder}/marts").run("1", F.lit("2024-02-01").cast("timestamp"), sessions, t.payments, pings, t.cities, ORDER)
    assert times.value == 400


@pytest.mark.parametrize("slice_sec", [60, 3600])
def test_joined_parts_are_the_shifts_of_numbered_pings(spark, slice_sec):
    """Nulls, moments that repeat, ends of shifts on both sides of a slice's border."""
    pick = random.Random(slice_sec)
    status, maybe = ("idle", "on_trip", "offline", None), lambda v: None if pick.random() < 0.1 else v
    rows = [
        (maybe(pick.choice("ab")), maybe(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=60 * pick.randrange(600))), maybe(12 + pick.random()),
         maybe(77 + pick.random()), maybe(pick.randrange(60) / 2), pick.choice(status), maybe(pick.randrange(5)), i)
        for i in range(300)
    ]
    pings = spark.createDataFrame(
        rows, "driver_id string, ts timestamp, lat double, lon double, speed_kmh double, status string, city_id int, ping_id long"
    )
    numbered = numbered_shifts(pings, ORDER, 900, slice_sec)
    want = numbered.groupBy(F.concat_ws(".", "driver_id", "shift_seq").alias("shift_id"), "driver_id").agg(
        F.min("city_id").alias("city_id"),
        F.min("ts").alias("shift_started_at"),
        F.max("ts").alias("shift_ended_at"),
        F.sum(F.when(F.col("is_new") == 1, 0.0).otherwise(F.col("step_km"))).alias("distance_km"),
        F.count(F.lit(1)).alias("ping_count"),
        F.avg("speed_kmh").alias("avg_speed_kmh"),
        F.avg((F.col("status").eqNullSafe("on_trip")).cast("double")).alias("on_trip_share"),
    )
    parts = shift_parts(pings, ORDER, 900, slice_sec)
    got = {r["shift_id"]: r for r in collect(joined_shifts(parts, 900).drop("active_minutes"))}
    expected = {r["shift_id"]: r for r in collect(want)}
    assert len(expected) > 20 and got.keys() == expected.keys()
    for key, row in expected.items():
        for name, value in row.items() if isinstance(row, dict) else row.asDict().items():
            assert got[key][name] == (pytest.approx(value) if isinstance(value, float) else value), (key, name)


def test_parts_take_one_scan_and_one_exchange(spark, folder):
    t = tables(spark, folder)
    landed = f"{folder}/pings"
    t.pings.write.parquet(landed)
    text = executed(shift_parts(spark.read.parquet(landed), ORDER))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "SortAggregate" not in text


def test_a_rewrite_scans_touched_partitions_only(spark, folder):
    rows = spark.createDataFrame([("a", 1, "d1"), ("b", 1, "d2"), ("c", 1, None)], "k string, v int, day string")
    table = KeyedTable(spark, f"{folder}/t", rows.schema, ["day"], ["k"])
    table.append(rows, "1")
    plans = []

    def doubled(old, new):
        plans.append(executed(old))
        return old.withColumn("v", F.col("v") * 2).unionByName(new)

    for n, day in enumerate(("d2", None), 2):
        table.merge(spark.createDataFrame([(f"new-{n}", 7, day)], rows.schema), str(n), doubled)
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ = d2", plans[0]), plans[0]
    assert re.search(r"PartitionFilters: \[[^\]]*isnull\(day#\d+\)", plans[1]), plans[1]
    want = [("a", 1, "d1"), ("b", 2, "d2"), ("c", 2, None), ("new-2", 7, "d2"), ("new-3", 7, None)]
    assert sorted(map(tuple, table.read().collect()), key=str) == want


def test_a_rewrite_keeps_partitions_whose_values_come_together_elsewhere(spark, folder):
    rows = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, "b", None)], "k int, p string, q int")
    table = VersionedTable(spark, f"{folder}/t", rows.schema, ["p", "q"])
    table.append(rows, "one")
    table.rewrite(rows.where("k IN (1, 4)").select("p", "q"), lambda old: old.withColumn("k", F.col("k") * 10), "two")
    assert sorted(r["k"] for r in table.read().collect()) == [2, 3, 10, 40]
    assert table.rewrite(rows.limit(0).select("p", "q"), lambda old: old, "three") is None
    assert sorted(r["k"] for r in table.read().collect()) == [2, 3, 10, 40]
