"""Record schemas and the fixed values of the ride domain."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------
# Lifecycle ordinal of each ride event type.
EVENT_ORDINALS = {
    "requested": 1,
    "matched": 2,
    "driver_arrived": 3,
    "started": 4,
    "completed": 5,
    "cancelled": 6,
}
TERMINAL_TYPES = ("completed", "cancelled")
TERMINAL_STATES = ("completed", "cancelled", "abandoned")
# Event types that may follow each event type of a ride.
LEGAL_NEXT = {
    "requested": ("matched", "cancelled"),
    "matched": ("driver_arrived", "cancelled"),
    "driver_arrived": ("started", "cancelled"),
    "started": ("completed", "cancelled"),
    "completed": (),
    "cancelled": (),
}
DRIVER_STATUSES = ("idle", "en_route_to_pickup", "on_trip", "offline")
PAYMENT_STATUSES = ("completed", "failed", "refunded")
PAYMENT_METHODS = ("card", "cash", "wallet")
CITY_IDS = (1, 2, 3, 4, 5)
LAT_BOUNDS = (8.0, 32.0)
LON_BOUNDS = (68.0, 92.0)
SURGE_BOUNDS = (1.0, 3.0)

EARTH_RADIUS_KM = 6371.0088
LATE_ARRIVAL_SEC = 600.0
SESSION_TIMEOUT_SEC = 2 * 3600
WATERMARK_DELAY_SEC = 30
MAX_LATENESS_SEC = 600
PAYMENT_BOUND_SEC = 15 * 60
PING_SESSION_GAP_SEC = 5 * 60
SHIFT_GAP_SEC = 30 * 60
FACT_LOOKBACK_SEC = 60 * 60
MATCH_BUCKET_SEC = 5
MATCH_LAST_BUCKET = 60
GOLD_RIDES = 30
SILVER_RIDES = 10
FRAME_OK = 0x00
FRAME_CORRUPT = 0xFF

# city_id, name, center_lat, center_lon, demand_weight
CITIES = (
    (1, "Bengaluru", 12.9716, 77.5946, 1.00),
    (2, "Mumbai", 19.0760, 72.8777, 0.95),
    (3, "Delhi", 28.6139, 77.2090, 0.90),
    (4, "Hyderabad", 17.3850, 78.4867, 0.60),
    (5, "Chennai", 13.0827, 80.2707, 0.55),
)
# --- end of fixed values ----------------------------------------------------------


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}


def _struct(text: str) -> T.StructType:
    """``name type`` pairs; a trailing ``!`` marks a column that is never null."""
    schema = T.StructType()
    for field in text.split(","):
        name, kind = field.split()
        schema.add(name, _TYPES[kind.rstrip("!")], not kind.endswith("!"))
    return schema


RIDE_EVENT_V1 = _struct(
    "event_id string!, ride_id string!, event_type string!, event_ts timestamp!, rider_id string!,"
    "driver_id string, city_id int!, pickup_lat double!, pickup_lon double!, dropoff_lat double,"
    "dropoff_lon double, fare_cents bigint, surge_multiplier double!, payload_version int!"
)
RIDE_EVENT = T.StructType([*RIDE_EVENT_V1.fields, T.StructField("promo_code", T.StringType())])

DRIVER_LOCATION = _struct(
    "driver_id string!, ts timestamp!, lat double!, lon double!, speed_kmh double!,"
    "heading double!, status string!, city_id int!"
)
PAYMENT = _struct(
    "txn_id string!, ride_id string!, amount_cents bigint!, status string!, method string!, ts bigint!"
)
RIDE_SESSION = _struct(
    "ride_id string!, rider_id string, driver_id string, city_id int, terminal_state string!,"
    "event_seq int!, requested_ts timestamp!, matched_ts timestamp, driver_arrived_ts timestamp,"
    "started_ts timestamp, ended_ts timestamp, time_to_match_sec double, time_to_pickup_sec double,"
    "ride_duration_sec double, haversine_distance_km double, avg_speed_kmh double,"
    "is_late_arrival boolean!, fare_cents bigint, surge_multiplier double!, promo_code string,"
    "pickup_lat double!, pickup_lon double!, dropoff_lat double, dropoff_lon double"
)
WIRE_MESSAGE = _struct("topic string!, partition int!, offset bigint!, key binary, value binary")
ENVELOPE = _struct(
    "source_topic string!, partition int!, offset bigint!, key_b64 string, payload_b64 string!,"
    "error string!, consumer_group string!, failed_at string!"
)
LANDED_EVENT_COLUMNS = (
    "ride_id", "event_seq", "event_id", "event_type", "event_ts", "rider_id", "driver_id",
    "city_id", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "fare_cents",
    "surge_multiplier", "payload_version", "promo_code", "kafka_partition", "kafka_offset",
    "ingested_at",
)
DQ_RESULT = _struct(
    "run_id string!, run_at timestamp!, suite string!, expectation string!, column_name string,"
    "success boolean!, element_count bigint, unexpected_count bigint, observed string, mode string!"
)
