from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fareflow.functions import geo, rides, times


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def lits(*numbers):
    return [F.lit(float(n)) for n in numbers]


@pytest.mark.parametrize(
    "a,b,km",
    [
        ((12.9716, 77.5946), (13.0827, 80.2707), 290.2),
        ((28.6139, 77.2090), (19.0760, 72.8777), 1153.0),
        ((40.7128, -74.0060), (51.5074, -0.1278), 5570.2),
    ],
)
def test_distances(spark, a, b, km):
    assert value(spark, geo.haversine_km(*lits(*a, *b))) == pytest.approx(km, rel=0.01)
    assert value(spark, geo.haversine_km(*lits(*a, *a))) == 0.0


def test_bearings(spark):
    assert value(spark, geo.initial_bearing_deg(*lits(0, 0, 1, 0))) == pytest.approx(0.0)
    assert value(spark, geo.initial_bearing_deg(*lits(0, 0, 0, 1))) == pytest.approx(90.0)
    assert value(spark, geo.initial_bearing_deg(*lits(0, 0, 0, -1))) == pytest.approx(270.0)


def test_destination_round_trip_and_wrap(spark):
    lat, lon, bearing, km = lits(12.97, 77.59, 137.0, 25.0)
    end_lat = geo.destination_lat(lat, bearing, km)
    end_lon = geo.destination_lon(lat, lon, bearing, km)
    assert value(spark, geo.haversine_km(lat, lon, end_lat, end_lon)) == pytest.approx(25.0)
    wrapped = value(spark, geo.destination_lon(*lits(0, 179.9, 90, 50)))
    assert -180.0 <= wrapped < -179.0


def test_times(spark):
    ts = F.timestamp_millis(F.lit(1_767_225_600_123))
    assert value(spark, times.iso_utc(ts)) == "2026-01-01T00:00:00.123+00:00"
    later = F.timestamp_millis(F.lit(1_767_225_602_122))
    assert value(spark, times.whole_seconds(ts, later)) == 1
    assert value(spark, times.elapsed_sec(later, ts)) == pytest.approx(1.999)
    assert value(spark, times.elapsed_sec(ts, later)) == 0.0
    assert value(spark, times.elapsed_sec(ts, F.lit(None).cast("timestamp"))) is None


@pytest.mark.parametrize("n,tier", [(None, "bronze"), (9, "bronze"), (10, "silver"), (29, "silver"), (30, "gold")])
def test_tiers(spark, n, tier):
    assert value(spark, rides.driver_tier(F.lit(n).cast("long"))) == tier


def test_buckets_and_rates(spark):
    assert value(spark, rides.match_bucket(F.lit(4.99))) == 0
    assert value(spark, rides.match_bucket(F.lit(5.0))) == 1
    assert value(spark, rides.match_bucket(F.lit(9999.0))) == 60
    assert value(spark, rides.match_bucket(F.lit(None).cast("double"))) is None
    assert value(spark, rides.rate(F.lit(1), F.lit(0))) is None
    assert value(spark, rides.event_ordinal(F.lit("teleported"))) is None
