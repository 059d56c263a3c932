"""Sliced computations against plain windows, with slices so narrow that most rows cross one."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fareflow.operators import quantiles, slices
from fareflow.operators.shifts import driver_shifts, numbered_shifts, ping_sessions
from tests.rides import T0, collect

ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "a", "a", "b", None]), st.integers(0, 60), st.integers(0, 9)),
    min_size=1,
    max_size=25,
)
FAST = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, key string, t long, v long")


@FAST
@given(ROWS)
def test_previous_row_and_running(spark, rows):
    df = frame(spark, rows)
    cut = F.floor(F.col("t") / 4).cast("long")
    plain = Window.partitionBy("key").orderBy("t", "id")
    before = plain.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select(
        "id",
        F.lag("v").over(plain).alias("prev"),
        F.max("v").over(before).alias("top"),
        F.sum("v").over(plain.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
    )
    a = slices.with_previous_row(df, ["key"], ["t", "id"], cut, ["v"]).select("id", "prev.v")
    b = slices.with_running(df, ["key"], ["t", "id"], cut, F.col("v"), "top", "max", False).select("id", "top")
    c = slices.with_running(df, ["key"], ["t", "id"], cut, F.col("v"), "total", "sum").select("id", "total")
    got = a.withColumnRenamed("v", "prev").join(b, "id").join(c, "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@FAST
@given(ROWS)
def test_islands(spark, rows):
    df = frame(spark, rows)
    plain = Window.partitionBy("key").orderBy("t", "id")
    opens = F.lag("t").over(plain).isNull() | (F.col("t") - F.lag("t").over(plain) > 3)
    want = df.withColumn("n", opens.cast("int")).select(
        "id", F.sum("n").over(plain.rowsBetween(Window.unboundedPreceding, 0)).alias("island")
    )
    got = slices.number_islands(
        df, ["key"], ["t", "id"], F.floor(F.col("t") / 4).cast("long"), ["t"], F.col("t") - F.col("prev.t") > 3,
    ).select("id", "island")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@FAST
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.floats(0, 500).map(lambda x: round(x, 3))), min_size=1, max_size=40))
def test_exact_quantiles(spark, rows):
    df = spark.createDataFrame(rows, "key string, v double")
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["key"]: r for r in quantiles.exact_quantiles(df, ["key"], "v", wanted).collect()}
    assert set(got) == {k for k, _ in rows}
    for key, row in got.items():
        values = [v for k, v in rows if k == key]
        assert row["n_values"] == len(values)
        for name, q in wanted.items():
            assert row[name] == pytest.approx(float(np.quantile(values, q)))


def test_quantiles_by_index_and_without_values(spark):
    df = spark.createDataFrame([(float(v),) for v in range(30)], "v double")
    got = quantiles.exact_quantiles(df, (), "v", {"p95": 0.95}, method="index").first()
    assert got["p95"] == 27.0  # sorted[int(0.95 * 30) - 1]
    assert quantiles.exact_quantiles(df.where("v < 0"), (), "v", {"p": 0.5}).count() == 0


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_quantiles_of_any_spread(spark, accuracy):
    """Values over forty powers of ten, all alike, mostly alike; coarse sketches leave the quantiles exact."""
    draw = random.Random(accuracy)
    groups = {
        "wide": [10.0 ** draw.uniform(-20, 20) for _ in range(3000)],
        "alike": [7.25] * 2000,
        "mostly": [1.0] * 1500 + [draw.random() for _ in range(1500)],
        "few": [3.0, 1.0],
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, v double").repartition(7)
    asked = {f"q{i}": q for i, q in enumerate((0.0, 0.01, 0.5, 0.951, 1.0))} | {"index": 0.95}
    methods = dict.fromkeys(asked, "linear") | {"index": "index"}
    got = quantiles.exact_quantiles(df, ["key"], "v", asked, methods, accuracy=accuracy).collect()
    assert sorted(r["key"] for r in got) == sorted(groups)
    for row in got:
        values = sorted(groups[row["key"]])
        assert row["index"] == values[max(int(0.95 * len(values)) - 1, 0)]
        for name, q in asked.items():
            if name != "index":
                assert row[name] == pytest.approx(float(np.quantile(values, q)), rel=1e-9)
    everything = quantiles.exact_quantiles(df, (), "v", {"p": 0.5}, accuracy=accuracy).first()
    assert everything["p"] == pytest.approx(float(np.median([v for _, v in rows])), rel=1e-9)


def test_histogram_and_bucket_quantiles(spark):
    hist = spark.createDataFrame([("w", 0, 1), ("w", 1, 8), ("w", 60, 1)], "w string, bucket int, cnt long")
    got = quantiles.histogram_quantiles(hist, ["w"], "bucket", "cnt", {"p50": 0.5, "p95": 0.95}, 5, "n").first()
    assert (got["p50"], got["p95"], got["n"]) == (10.0, 305.0, 10)
    inf = float("inf")
    buckets = spark.createDataFrame(
        [("a", 1.0, 10), ("a", 2.0, 100), ("a", inf, 100), ("b", 1.0, 1), ("b", inf, 100)],
        "k string, le double, n long",
    )
    got = {r["k"]: r["p"] for r in quantiles.bucket_quantile(buckets, ["k"], "le", "n", 0.95, "p").collect()}
    assert got["a"] == pytest.approx(1 + 85 / 90) and got["b"] == 1.0


def pings(spark, rows):
    df = spark.createDataFrame(
        [("d", T0 + sec * 1000, 12.0 + i * 0.01, 77.0, 30.0, status, 1) for i, (sec, status) in enumerate(rows)],
        "driver_id string, ts long, lat double, lon double, speed_kmh double, status string, city_id int",
    )
    return df.withColumn("ts", F.timestamp_millis("ts"))


def test_shift_edges(spark):
    """A gap of exactly 30 minutes stays in the shift; offline ends it; every hour is a slice."""
    rows = pings(spark, [(0, "idle"), (1800, "on_trip"), (3601, "offline"), (3700, "idle"), (5501, "idle")])
    assert [r["shift_seq"] for r in numbered_shifts(rows, slice_sec=600).orderBy("ts").collect()] == [1, 1, 2, 3, 4]
    shifts = {r["shift_id"]: r for r in collect(driver_shifts(rows, slice_sec=600))}
    assert set(shifts) == {"d.1", "d.2", "d.3", "d.4"}
    first = shifts["d.1"]
    assert (first["active_minutes"], first["ping_count"], first["on_trip_share"]) == (30.0, 2, 0.5)
    assert first["distance_km"] == pytest.approx(1.112, rel=0.01)
    assert shifts["d.2"]["distance_km"] == 0.0


def test_ping_session_edges(spark):
    rows = pings(spark, [(0, "idle"), (300, "idle"), (601, "idle")])
    got = sorted(collect(ping_sessions(rows, slice_sec=60)), key=lambda r: r["session_start"])
    assert [(r["ping_count"], r["active_minutes"]) for r in got] == [(2, 5.0), (1, 0.0)]
    assert got[0]["session_end"] == T0 + 600_000
    assert got[0]["distance_km"] == pytest.approx(30.0 * 300 / 3600)
