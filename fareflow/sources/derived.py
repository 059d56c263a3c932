"""Ride, payment and ping tables derived from the driver's ``events`` table.

Each event becomes one ride event, one ping and, for purchases, one payment. ``sql_with``
states the same derivations as SQL common table expressions for the DuckDB check.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.operators.sessions import build_sessions
from fareflow.schemas import CITIES, EVENT_ORDINALS, RIDE_EVENT
from fareflow.session import apply_settings

EVENT_TYPE_SQL = """CASE event_type WHEN 'signup' THEN 'requested' WHEN 'view' THEN 'matched'
 WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'driver_arrived' ELSE 'started' END
 WHEN 'purchase' THEN 'completed' ELSE 'cancelled' END"""
CITY_ROWS = ", ".join(
    f"({i}, '{name}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE), CAST({weight} AS DOUBLE))"
    for i, name, lat, lon, weight in CITIES
)
CITY_SQL = f"SELECT * FROM (VALUES {CITY_ROWS}) AS t(city_id, name, center_lat, center_lon, demand_weight)"


class DriverTables:
    """The driver's parquet tables and what Spark derives from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in zoned}) if zoned else df

    @property
    def events(self) -> DataFrame:
        return numbered_events(self.table("events"))

    @cached_property
    def cities(self) -> DataFrame:
        return self.spark.sql(CITY_SQL)

    @property
    def ride_events(self) -> DataFrame:
        return to_ride_events(self.events)

    @property
    def sessions(self) -> DataFrame:
        return build_sessions(self.ride_events)

    @property
    def payments(self) -> DataFrame:
        return to_payments(self.events)

    @property
    def pings(self) -> DataFrame:
        return to_pings(self.events)


    @property
    def wire(self) -> DataFrame:
        return to_wire(to_ride_events(self.events))

    @property
    def payment_texts(self) -> DataFrame:
        return to_payment_texts(self.events)


def numbered_events(events: DataFrame) -> DataFrame:
    """Parse ``props`` and add millisecond time, source partition and a unique arrival offset."""
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        F.date_trunc("MILLISECOND", "ts").alias("ts"),
        "value",
        "props",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("user_id") % 4).cast("int").alias("kafka_partition"),
        F.expr("(event_id + (event_id * 7919) % 97) * 128 + event_id % 128").alias("kafka_offset"),
    )


RIDE_ID_SQL = "concat(user_id, '-', CAST(floor(unix_seconds(ts) / 259200) AS BIGINT))"
CENTER_LAT = " ".join(f"WHEN {i} THEN {c[2]}D" for i, c in enumerate(CITIES))
CENTER_LON = " ".join(f"WHEN {i} THEN {c[3]}D" for i, c in enumerate(CITIES))


def to_ride_events(events: DataFrame) -> DataFrame:
    """One ride event per event; a ride is what a user does in three days."""
    lat, lon = (f"(CASE user_id % 5 {c} END)" for c in (CENTER_LAT, CENTER_LON))
    ordinals = ", ".join(f"'{name}'" for name in EVENT_ORDINALS)
    typed = events.withColumn("event_type", F.expr(EVENT_TYPE_SQL)).withColumn("ride_id", F.expr(RIDE_ID_SQL))
    return typed.selectExpr(
        f"concat(ride_id, '.', array_position(array({ordinals}), event_type)) AS event_id",
        "ride_id",
        "event_type",
        "ts AS event_ts",
        "concat('u-', user_id) AS rider_id",
        "CASE WHEN event_type <> 'requested' AND k % 4 <> 0 THEN concat('d-', (user_id + k % 2) % 10) END AS driver_id",
        "CAST(user_id % 5 + 1 AS INT) AS city_id",
        f"{lat} + (event_id % 11 - 5) / 100.0D AS pickup_lat",
        f"{lon} + (event_id % 11 - 5) / 100.0D AS pickup_lon",
        f"CASE WHEN k % 3 <> 0 THEN {lat} + (event_id % 7 - 3) / 50.0D END AS dropoff_lat",
        f"CASE WHEN k % 3 <> 0 THEN {lon} + (event_id % 7 - 3) / 50.0D END AS dropoff_lon",
        "CASE WHEN event_type = 'completed' THEN CAST(round(value * 100) AS BIGINT) END AS fare_cents",
        "CASE WHEN k = 50 THEN 0.0D ELSE 1 + (k % 9) / 4.0D END AS surge_multiplier",
        "CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS payload_version",
        "CASE WHEN event_id % 3 = 0 AND k % 5 = 0 THEN concat('SAVE', (k % 4 + 1) * 5) END AS promo_code",
        "kafka_partition",
        "kafka_offset",
        "event_id AS source_id",
        "k",
    )


def to_payments(events: DataFrame) -> DataFrame:
    """A payment per purchase, 0 to 20 minutes after it; one purchase in ten is never paid."""
    return events.where("event_type = 'purchase' AND k % 10 <> 0").selectExpr(
        "concat('txn-', event_id) AS txn_id",
        f"{RIDE_ID_SQL} AS ride_id",
        "CAST(round(value * 100) AS BIGINT) + CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS amount_cents",
        "element_at(array('completed', 'failed', 'refunded'), k % 3 + 1) AS status",
        "element_at(array('card', 'cash', 'wallet'), k % 7 % 3 + 1) AS method",
        "timestamp_millis(unix_millis(ts) + k * 13000 % 1200000) AS payment_ts",
    )


def to_pings(events: DataFrame) -> DataFrame:
    """One ping per event; ten drivers share the users."""
    return events.selectExpr(
        "concat('d-', user_id % 10) AS driver_id",
        "ts",
        "12.0D + (event_id * 31 % 101) / 1000.0D AS lat",
        "77.0D + (event_id * 17 % 101) / 1000.0D AS lon",
        "k * 0.5D AS speed_kmh",
        "event_id % 360 * 1.0D AS heading",
        "CASE event_type WHEN 'signup' THEN 'idle' WHEN 'view' THEN 'en_route_to_pickup'"
        " WHEN 'error' THEN CASE WHEN k % 4 = 0 THEN 'offline' ELSE 'idle' END"
        " ELSE 'on_trip' END AS status",
        "CAST(user_id % 5 + 1 AS INT) AS city_id",
        "event_id AS ping_id",
    )


def _json_body(fault: Column) -> Column:
    return F.to_json(
        F.struct(
            "event_id",
            F.when(fault != 2, F.col("ride_id")).alias("ride_id"),
            F.when(fault == 3, "teleported").otherwise(F.col("event_type")).alias("event_type"),
            F.unix_millis("event_ts").alias("event_ts"),
            *RIDE_EVENT.names[4:-2],
            F.when(F.col("payload_version") == 2, 2).alias("payload_version"),
            "promo_code",
        )
    )


def to_wire(ride_events: DataFrame) -> DataFrame:
    """Ride events as framed JSON messages, some of them poisoned according to ``k``.

    ``k % 13``: 0 wrong frame byte, 1 cut-off body, 2 no ride id, 3 unknown event type. Version 1
    bodies carry neither ``promo_code`` nor ``payload_version``.
    """
    fault = F.col("k") % 13
    body = F.when(fault == 1, F.expr("left(_body, length(_body) - 5)")).otherwise(F.col("_body"))
    return (
        ride_events.withColumn("_body", _json_body(fault))
        .withColumn("_frame", F.when(fault == 0, F.lit(b"\xff")).otherwise(F.lit(b"\x00")))
        .select(
            F.lit("rides.events").alias("topic"),
            F.col("kafka_partition").alias("partition"),
            F.col("kafka_offset").alias("offset"),
            F.when(F.col("k") % 11 != 0, F.encode("ride_id", "UTF-8")).alias("key"),
            F.concat("_frame", F.encode(body, "UTF-8")).alias("value"),
            "k",
        )
    )


def to_payment_texts(events: DataFrame) -> DataFrame:
    """Payment messages as JSON text, faulty in nine ways according to ``event_id % 12``."""
    faults = {
        0: """concat('{"txn_id":"txn-', event_id, '",')""",
        1: """concat('{"txn_id":"txn-', event_id, '","ride_id":"r","amount_cents":', cents, ',"method":"card","ts":', ms, '}')""",
        2: _payment_sql("concat('-', cents + 1)"),
        3: _payment_sql("cents", status="captured"),
        4: _payment_sql("cents", more=',"note":1'),
        5: _payment_sql("""concat('"', cents, '"')"""),
        6: _payment_sql("cents", ms="""concat('"', ms, '"')"""),
        7: "'[1,2]'",
        8: _payment_sql("concat(cents, '.5')"),
        9: _payment_sql("concat(cents, '.0')"),
    }
    cases = " ".join(f"WHEN {n} THEN {sql}" for n, sql in faults.items())
    return (
        events.where(F.col("event_type") == "purchase")
        .withColumn("cents", F.round(F.col("value") * 100).cast("long"))
        .withColumn("ms", F.unix_millis("ts"))
        .select("event_id", F.expr(f"CASE event_id % 12 {cases} ELSE {_payment_sql('cents')} END").alias("value"))
    )


def _payment_sql(amount: str, status: str = "completed", ms: str = "ms", more: str = "") -> str:
    return (
        """concat('{"txn_id":"txn-', event_id, '","ride_id":"r-', user_id, '","amount_cents":', """
        f"""{amount}, ',"status":"{status}","method":"card","ts":', {ms}, '{more}}}')"""
    )


# --- the same derivations for the DuckDB check -----------------------------------------

_CENTER_LAT = " ".join(f"WHEN {i} THEN {c[2]}" for i, c in enumerate(CITIES))
_CENTER_LON = " ".join(f"WHEN {i} THEN {c[3]}" for i, c in enumerate(CITIES))

CTES = {
    "ev": """SELECT event_id, user_id, event_type, date_trunc('milliseconds', ts) AS ts, value, props,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(user_id % 4 AS INTEGER) AS kafka_partition,
  (event_id + (event_id * 7919) % 97) * 128 + event_id % 128 AS kafka_offset FROM events""",
    "cities": CITY_SQL,
    "ride_typed": f"SELECT * EXCLUDE (event_type), {EVENT_TYPE_SQL} AS event_type FROM ev",
    "ride_events": f"""SELECT ride_id || '.' || seq AS event_id, * EXCLUDE (seq) FROM (SELECT
  user_id || '-' || CAST(floor(epoch(ts) / 259200) AS BIGINT) AS ride_id, event_type, ts AS event_ts,
  list_position(['requested','matched','driver_arrived','started','completed','cancelled'], event_type) AS seq,
  'u-' || user_id AS rider_id,
  CASE WHEN event_type <> 'requested' AND k % 4 <> 0 THEN 'd-' || ((user_id + k % 2) % 10) END AS driver_id,
  CAST(user_id % 5 + 1 AS INTEGER) AS city_id,
  CAST(CASE user_id % 5 {_CENTER_LAT} END AS DOUBLE) + (event_id % 11 - 5) / 100.0::DOUBLE AS pickup_lat,
  CAST(CASE user_id % 5 {_CENTER_LON} END AS DOUBLE) + (event_id % 11 - 5) / 100.0::DOUBLE AS pickup_lon,
  CASE WHEN k % 3 <> 0 THEN CAST(CASE user_id % 5 {_CENTER_LAT} END AS DOUBLE) + (event_id % 7 - 3) / 50.0::DOUBLE END AS dropoff_lat,
  CASE WHEN k % 3 <> 0 THEN CAST(CASE user_id % 5 {_CENTER_LON} END AS DOUBLE) + (event_id % 7 - 3) / 50.0::DOUBLE END AS dropoff_lon,
  CASE WHEN event_type = 'completed' THEN CAST(round(value * 100) AS BIGINT) END AS fare_cents,
  CASE WHEN k = 50 THEN 0.0::DOUBLE ELSE 1 + (k % 9) / 4.0::DOUBLE END AS surge_multiplier,
  CASE WHEN event_id % 3 = 0 THEN 2 ELSE 1 END AS payload_version,
  CASE WHEN event_id % 3 = 0 AND k % 5 = 0 THEN 'SAVE' || ((k % 4 + 1) * 5) END AS promo_code,
  kafka_partition, kafka_offset, event_id AS source_id, k FROM ride_typed)""",
    "payments": """SELECT 'txn-' || event_id AS txn_id,
  user_id || '-' || CAST(floor(epoch(ts) / 259200) AS BIGINT) AS ride_id,
  CAST(round(value * 100) AS BIGINT) + CASE WHEN k % 17 = 0 THEN 1 ELSE 0 END AS amount_cents,
  ['completed', 'failed', 'refunded'][k % 3 + 1] AS status, ['card', 'cash', 'wallet'][k % 7 % 3 + 1] AS method,
  make_timestamp_ms(epoch_ms(ts) + k * 13000 % 1200000) AS payment_ts
  FROM ev WHERE event_type = 'purchase' AND k % 10 <> 0""",
    "pings": """SELECT 'd-' || (user_id % 10) AS driver_id, ts, 12.0::DOUBLE + (event_id * 31 % 101) / 1000.0::DOUBLE AS lat,
  77.0::DOUBLE + (event_id * 17 % 101) / 1000.0::DOUBLE AS lon, k * 0.5::DOUBLE AS speed_kmh,
  event_id % 360 * 1.0::DOUBLE AS heading,
  CASE event_type WHEN 'signup' THEN 'idle' WHEN 'view' THEN 'en_route_to_pickup'
   WHEN 'error' THEN CASE WHEN k % 4 = 0 THEN 'offline' ELSE 'idle' END ELSE 'on_trip' END AS status,
  CAST(user_id % 5 + 1 AS INTEGER) AS city_id, event_id AS ping_id FROM ev""",
    "slots": """SELECT *, list_position(['requested','matched','driver_arrived','started','completed','cancelled'],
   event_type) AS seq FROM (SELECT *, row_number() OVER (PARTITION BY ride_id, event_type ORDER BY kafka_offset DESC) AS rn,
   min(kafka_offset) OVER (PARTITION BY ride_id, event_type) AS seen FROM ride_events) WHERE rn = 1""",
    "folded": """SELECT ride_id, arg_min(rider_id, seq) FILTER (rider_id IS NOT NULL) AS rider_id,
  arg_min(driver_id, seq) FILTER (driver_id IS NOT NULL) AS driver_id,
  arg_min(city_id, seq) FILTER (city_id IS NOT NULL) AS city_id,
  arg_min(event_type, seen) FILTER (seq >= 5) AS terminal, CAST(count(*) AS INTEGER) AS event_seq,
  max(event_ts) AS last_ts, max(event_ts) FILTER (seq = 1) AS t1, max(event_ts) FILTER (seq = 2) AS t2,
  max(event_ts) FILTER (seq = 3) AS t3, max(event_ts) FILTER (seq = 4) AS t4,
  max(event_ts) FILTER (seq = 5) AS t5, max(event_ts) FILTER (seq = 6) AS t6,
  max(fare_cents) FILTER (seq = 5) AS fare_cents,
  coalesce(nullif(arg_min(surge_multiplier, seq), 0), 1.0::DOUBLE) AS surge_multiplier,
  arg_min(promo_code, seq) FILTER (promo_code IS NOT NULL) AS promo_code,
  arg_min(pickup_lat, seq) AS pickup_lat, arg_min(pickup_lon, seq) AS pickup_lon,
  arg_min(dropoff_lat, seq) FILTER (dropoff_lat IS NOT NULL) AS dropoff_lat,
  arg_min(dropoff_lon, seq) FILTER (dropoff_lon IS NOT NULL) AS dropoff_lon FROM slots GROUP BY ride_id""",
    "timed": """SELECT *, greatest(epoch_ms(t2) - epoch_ms(t1), 0) / 1000.0::DOUBLE * CASE WHEN t1 IS NULL OR t2 IS NULL THEN NULL ELSE 1 END AS ttm,
  greatest(epoch_ms(t3) - epoch_ms(t2), 0) / 1000.0::DOUBLE * CASE WHEN t2 IS NULL OR t3 IS NULL THEN NULL ELSE 1 END AS ttp,
  CASE WHEN terminal = 'completed' AND t4 IS NOT NULL THEN greatest(epoch_ms(t5) - epoch_ms(t4), 0) / 1000.0::DOUBLE END AS dur,
  2 * 6371.0088 * asin(sqrt(power(sin(radians(dropoff_lat - pickup_lat) / 2), 2) + cos(radians(pickup_lat))
   * cos(radians(dropoff_lat)) * power(sin(radians(dropoff_lon - pickup_lon) / 2), 2))) AS km FROM folded""",
    "sessions": """SELECT ride_id, rider_id, driver_id, city_id, coalesce(terminal, 'abandoned') AS terminal_state, event_seq,
  coalesce(t1, last_ts) AS requested_ts, t2 AS matched_ts, t3 AS driver_arrived_ts, t4 AS started_ts,
  CASE terminal WHEN 'completed' THEN t5 WHEN 'cancelled' THEN t6 END AS ended_ts,
  ttm AS time_to_match_sec, ttp AS time_to_pickup_sec, dur AS ride_duration_sec, km AS haversine_distance_km,
  CASE WHEN dur > 0 THEN km / (dur / 3600.0) END AS avg_speed_kmh, coalesce(ttp > 600, false) AS is_late_arrival,
  fare_cents, surge_multiplier, promo_code, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon FROM timed
  WHERE terminal IS NOT NULL OR (SELECT max(event_ts) FROM ride_events) > last_ts + INTERVAL 2 HOUR""",
}
_NEEDS = {
    "cities": (),
    "ev": (),
    "ride_typed": ("ev",),
    "ride_events": ("ride_typed",),
    "payments": ("ev",),
    "pings": ("ev",),
    "slots": ("ride_events",),
    "folded": ("slots",),
    "timed": ("folded",),
    "sessions": ("timed",),
}


def sql_with(names: tuple[str, ...], extra: dict[str, str] | None = None) -> str:
    """A WITH clause that defines the named tables, what they need, and ``extra`` ones."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for need in _NEEDS[name]:
                visit(need)
            order.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS ({CTES[n]})" for n in order]
    parts += [f"{n} AS ({body})" for n, body in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n"
