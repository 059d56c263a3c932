"""Ride fixtures: one ride with known times, and helpers to turn dicts into DataFrames."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.schemas import EVENT_ORDINALS, RIDE_EVENT

T0 = 1_767_225_600_000
MATCH, ARRIVE, START, END = T0 + 30_000, T0 + 210_000, T0 + 250_000, T0 + 1_150_000
PICKUP, DROPOFF = (12.9716, 77.5946), (12.9352, 77.6245)

SCHEMA = T.StructType(
    [
        *[
            T.StructField(f.name, T.LongType() if f.name == "event_ts" else f.dataType)
            for f in RIDE_EVENT.fields
        ],
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
    ]
)


def event(kind: str, ts: int, ride: str = "r-1", **extra) -> dict:
    return {
        "event_id": f"{ride}.{EVENT_ORDINALS.get(kind, 0)}",
        "ride_id": ride,
        "event_type": kind,
        "event_ts": ts,
        "rider_id": "u-7",
        "driver_id": None,
        "city_id": 1,
        "pickup_lat": PICKUP[0],
        "pickup_lon": PICKUP[1],
        "dropoff_lat": None,
        "dropoff_lon": None,
        "fare_cents": None,
        "surge_multiplier": 1.2,
        "payload_version": 1,
        "promo_code": None,
        **extra,
    }


def full_ride(ride: str = "r-1", shift: int = 0, driver: str = "d-1") -> list[dict]:
    end = {"dropoff_lat": DROPOFF[0], "dropoff_lon": DROPOFF[1]}
    return [
        event("requested", T0 + shift, ride, **end),
        event("matched", MATCH + shift, ride, driver_id=driver),
        event("driver_arrived", ARRIVE + shift, ride, driver_id=driver),
        event("started", START + shift, ride, driver_id=driver),
        event("completed", END + shift, ride, driver_id=driver, fare_cents=31_400, **end),
    ]


def events_df(spark, events: list[dict], first_offset: int = 0):
    rows = [
        tuple({"kafka_partition": 0, "kafka_offset": first_offset + i, **e}[n] for n in SCHEMA.names)
        for i, e in enumerate(events)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("event_ts", F.timestamp_millis("event_ts"))


def with_ms(df):
    """Timestamps as epoch milliseconds, so that tests do not depend on the machine's zone."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.unix_millis(c) for c in stamps})


def collect(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in with_ms(df).collect()]
