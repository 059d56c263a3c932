"""Sources, decoding, dead letters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.checks.registry import query
from fareflow.functions import geo, rides, times
from fareflow.operators import poison
from fareflow.operators.sessions import with_session_ts
from fareflow.plans import marts
from fareflow.schemas import RIDE_EVENT, RIDE_EVENT_V1
from fareflow.session import work_dir
from fareflow.sources import seeds
from fareflow.sources.derived import DriverTables

FAILED_AT = "2024-02-01 00:00:00"
EVENT_COLUMNS = ", ".join(RIDE_EVENT.names)
ERROR_SQL = """CASE k % 13 WHEN 0 THEN 'bad frame byte' WHEN 1 THEN 'undecodable body' WHEN 2 THEN 'undecodable body'
 WHEN 3 THEN 'unknown event type' END"""


def _failed_at():
    return F.lit(FAILED_AT).cast("timestamp")


@query("session_time", "SELECT ride_id, coalesce(ended_ts, requested_ts) AS session_ts FROM sessions", ("sessions",))
def session_time(t: DriverTables) -> DataFrame:
    return with_session_ts(t.sessions).select("ride_id", "session_ts")


@query(
    "payment_source",
    """SELECT CASE WHEN event_id % 12 = 1 THEN 'r' ELSE 'r-' || user_id END AS ride_id, 'txn-' || event_id AS txn_id,
  CASE event_id % 12 WHEN 2 THEN -(c + 1) WHEN 8 THEN NULL ELSE c END AS amount_cents,
  CASE event_id % 12 WHEN 1 THEN NULL WHEN 3 THEN 'captured' ELSE 'completed' END AS status, 'card' AS method, ts AS payment_ts
  FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM ev) WHERE event_type = 'purchase' AND event_id % 12 NOT IN (0, 7)""",
    ("ev",),
)
def payment_source(t: DriverTables) -> DataFrame:
    return poison.parseable_payments(t.payment_texts)


@query(
    "frame_decode",
    f"SELECT {EVENT_COLUMNS}, kafka_partition, kafka_offset FROM ride_events WHERE k % 13 > 3",
    ("ride_events",),
)
def frame_decode(t: DriverTables) -> DataFrame:
    return poison.clean_rows(poison.decode_ride_events(t.wire))


@query(
    "version_tolerant_read",
    f"SELECT {EVENT_COLUMNS.replace('promo_code', 'CASE WHEN payload_version = 2 THEN promo_code END AS promo_code')} FROM ride_events",
    ("ride_events",),
)
def version_tolerant_read(t: DriverTables) -> DataFrame:
    events = t.ride_events
    old = events.where("payload_version = 1").select(*RIDE_EVENT_V1.names)
    new = events.where("payload_version = 2").select(*RIDE_EVENT.names)
    return new.unionByName(old, allowMissingColumns=True)


@query(
    "payment_validation",
    """SELECT event_id, CASE event_id % 12 WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'missing key' WHEN 2 THEN 'negative amount'
  WHEN 3 THEN 'value not allowed' WHEN 4 THEN 'extra key' WHEN 5 THEN 'wrong type' WHEN 6 THEN 'wrong type'
  WHEN 7 THEN 'not a JSON object' WHEN 8 THEN 'wrong type' END AS error FROM ev WHERE event_type = 'purchase'""",
    ("ev",),
)
def payment_validation(t: DriverTables) -> DataFrame:
    return poison.decode_payments(t.payment_texts).select("event_id", "error")


@query(
    "poison_split",
    f"SELECT kafka_partition AS partition, kafka_offset AS \"offset\", {ERROR_SQL} AS error FROM ride_events",
    ("ride_events",),
)
def poison_split(t: DriverTables) -> DataFrame:
    return poison.decode_ride_events(t.wire).select("partition", "offset", "error")


def _short_messages(t: DriverTables) -> DataFrame:
    return t.events.select(
        F.lit("rides.events").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.when(F.col("k") % 11 != 0, F.encode(F.col("user_id").cast("string"), "UTF-8")).alias("key"),
        F.concat(F.lit(b"\xff"), F.encode(F.concat("event_id", "props"), "UTF-8")).alias("value"),
    )


@query(
    "dead_letter_envelopes",
    f"""SELECT 'rides.events' AS source_topic, kafka_partition AS partition, kafka_offset AS "offset",
  CASE WHEN k % 11 <> 0 THEN to_base64(encode(CAST(user_id AS VARCHAR))) END AS key_b64,
  to_base64('\\xFF'::BLOB || encode(event_id || props)) AS payload_b64, 'bad frame byte' AS error,
  'sessionizer' AS consumer_group, '{FAILED_AT.replace(' ', 'T')}.000+00:00' AS failed_at FROM ev""",
    ("ev",),
)
def dead_letter_envelopes(t: DriverTables) -> DataFrame:
    decoded = poison.decode_ride_events(_short_messages(t))
    texts = poison.envelope_json(poison.envelopes(decoded, "sessionizer", _failed_at()))
    return poison.parse_envelopes(texts)


@query(
    "clean_mirror",
    """SELECT event_id, event_ts, kafka_partition, kafka_offset FROM ride_events WHERE k % 13 > 3""",
    ("ride_events",),
)
def clean_mirror(t: DriverTables) -> DataFrame:
    return poison.clean_rows(poison.decode_ride_events(t.wire)).select(
        "event_id", "event_ts", "kafka_partition", "kafka_offset"
    )


REPLAY_FILTER = "error = 'bad frame byte' AND partition <> 3"


@query(
    "dead_letter_replay_stats",
    """SELECT count(*) AS seen, count(*) FILTER (WHERE NOT keep) AS filtered_out, count(*) FILTER (WHERE keep) AS replayed,
  false AS dry_run FROM (SELECT k % 13 = 0 AND kafka_partition <> 3 AS keep FROM ride_events WHERE k % 13 <= 3)""",
    ("ride_events",),
)
def dead_letter_replay_stats(t: DriverTables) -> DataFrame:
    dead = poison.envelopes(poison.decode_ride_events(t.wire), "sink", _failed_at())
    return poison.replay(dead, REPLAY_FILTER, poison.repair_frame).stats


@query(
    "dead_letter_repair",
    f"SELECT {EVENT_COLUMNS} FROM ride_events WHERE k % 13 = 0 AND kafka_partition <> 3",
    ("ride_events",),
)
def dead_letter_repair(t: DriverTables) -> DataFrame:
    """Poison is filtered, repaired, sent again and decoded: the lost events come back."""
    dead = poison.envelopes(poison.decode_ride_events(t.wire), "sink", _failed_at())
    again = poison.replay(dead, REPLAY_FILTER, poison.repair_frame).messages
    return poison.decode_ride_events(again).where("error IS NULL").select("record.*")


@query(
    "dead_letter_transform",
    """SELECT md5(event_id || props) AS digest, count(*) AS n FROM ev GROUP BY 1""",
    ("ev",),
)
def dead_letter_transform(t: DriverTables) -> DataFrame:
    """A bytes-to-bytes repair function, run over Arrow batches."""
    dead = poison.envelopes(poison.decode_ride_events(_short_messages(t)), "sink", _failed_at())
    sent = poison.replay(dead, transform=poison.bytes_transform(lambda b: b[1:])).messages
    return sent.groupBy(F.md5("value").alias("digest")).agg(F.count(F.lit(1)).alias("n"))


#: Cities made of the nations, as a seed file would list them.
SEED_SQL = """SELECT CAST(n_nationkey AS INTEGER) AS city_id, n_name AS name, n_nationkey * 2.5::DOUBLE AS center_lat,
  n_regionkey * 10 - 0.5::DOUBLE AS center_lon, 1 + n_regionkey / 4.0::DOUBLE AS demand_weight FROM nation"""


def seeded_cities(t: DriverTables) -> DataFrame:
    """The nations written as a CSV seed and loaded with fixed types."""
    folder = work_dir(t.spark, "seed")
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    rows = t.table("nation").select(
        key.alias("city_id"),
        F.col("n_name").alias("name"),
        (key * 2.5).alias("center_lat"),
        (region * 10 - 0.5).alias("center_lon"),
        (region / 4.0 + 1).alias("demand_weight"),
    )
    rows.write.option("header", True).csv(folder)
    return seeds.load_seed(t.spark, folder, seeds.CITY_SEED)


@query("city_seed", SEED_SQL)
def city_seed(t: DriverTables) -> DataFrame:
    return seeded_cities(t)


@query(
    "nation_seed",
    "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def nation_seed(t: DriverTables) -> DataFrame:
    nations, regions = t.table("nation"), t.table("region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


# --- scalars -------------------------------------------------------------------------------


@query(
    "staged_sessions",
    """SELECT ride_id, event_seq, requested_ts AS requested_at, matched_ts AS matched_at, driver_arrived_ts AS driver_arrived_at,
  started_ts AS started_at, ended_ts AS ended_at, CAST(fare_cents AS BIGINT) AS fare_cents FROM sessions""",
    ("sessions",),
)
def staged_sessions(t: DriverTables) -> DataFrame:
    return marts.stage_sessions(t.sessions).select(
        "ride_id", "event_seq", "requested_at", "matched_at", "driver_arrived_at", "started_at",
        "ended_at", "fare_cents",
    )


@query(
    "staged_events",
    "SELECT event_id, ride_id, event_type, event_ts AS event_at, city_id, fare_cents FROM ride_events",
    ("ride_events",),
)
def staged_events(t: DriverTables) -> DataFrame:
    return marts.stage_events(t.ride_events).select(
        "event_id", "ride_id", "event_type", "event_at", "city_id", "fare_cents"
    )


@query(
    "staged_payments",
    "SELECT txn_id, ride_id, amount_cents, status, method, payment_ts AS paid_at FROM payments",
    ("payments",),
)
def staged_payments(t: DriverTables) -> DataFrame:
    return marts.stage_payments(t.payments)


@query("staged_locations", "SELECT * EXCLUDE (ts), ts AS pinged_at FROM pings", ("pings",))
def staged_locations(t: DriverTables) -> DataFrame:
    return marts.stage_locations(t.pings)


@query(
    "event_ordinals",
    """SELECT source_id, list_position(['requested','matched','driver_arrived','started','completed','cancelled'],
  CASE WHEN k % 13 = 3 THEN 'teleported' ELSE event_type END) AS ordinal FROM ride_events""",
    ("ride_events",),
)
def event_ordinals(t: DriverTables) -> DataFrame:
    kind = F.when(F.col("k") % 13 == 3, "teleported").otherwise(F.col("event_type"))
    return t.ride_events.select("source_id", rides.event_ordinal(kind).alias("ordinal"))


def _points():
    return F.col("pickup_lat"), F.col("pickup_lon"), F.col("dropoff_lat"), F.col("dropoff_lon")


@query(
    "haversine_distance",
    """SELECT source_id, round(2 * 6371.0088 * asin(sqrt(power(sin(radians(dropoff_lat - pickup_lat) / 2), 2)
  + cos(radians(pickup_lat)) * cos(radians(dropoff_lat)) * power(sin(radians(dropoff_lon - pickup_lon) / 2), 2))), 6) AS km
  FROM ride_events""",
    ("ride_events",),
)
def haversine_distance(t: DriverTables) -> DataFrame:
    return t.ride_events.select("source_id", F.round(geo.haversine_km(*_points()), 6).alias("km"))


@query(
    "initial_bearing",
    """SELECT source_id, CASE WHEN abs(dropoff_lat - pickup_lat) > 0.001 OR abs(dropoff_lon - pickup_lon) > 0.001 THEN
   round(((degrees(atan2(sin(dl) * cos(b), cos(a) * sin(b) - sin(a) * cos(b) * cos(dl))) + 360) % 360), 5) ELSE 0 END AS bearing
  FROM (SELECT *, radians(pickup_lat) AS a, radians(dropoff_lat) AS b, radians(dropoff_lon - pickup_lon) AS dl FROM ride_events)""",
    ("ride_events",),
)
def initial_bearing(t: DriverTables) -> DataFrame:
    """Bearings of all trips; the heading of a zero-length one is noise and stands as 0."""
    lat1, lon1, lat2, lon2 = _points()
    moved = (F.abs(lat2 - lat1) > 0.001) | (F.abs(lon2 - lon1) > 0.001)
    bearing = F.when(moved, F.round(geo.initial_bearing_deg(*_points()), 5)).otherwise(0.0)
    return t.ride_events.select("source_id", bearing.alias("bearing"))


@query(
    "destination_point",
    """SELECT ping_id, round(degrees(p2), 6) AS lat,
  round((degrees(radians(lon) + atan2(sin(th) * sin(de) * cos(p1), cos(de) - sin(p1) * sin(p2))) + 540) % 360 - 180, 6) AS lon
  FROM (SELECT *, asin(sin(p1) * cos(de) + cos(p1) * sin(de) * cos(th)) AS p2 FROM
   (SELECT ping_id, lon, radians(lat) AS p1, radians(heading) AS th, (speed_kmh * 100) / 6371.0088 AS de FROM pings))""",
    ("pings",),
)
def destination_point(t: DriverTables) -> DataFrame:
    lat, lon, bearing = F.col("lat"), F.col("lon"), F.col("heading")
    km = F.col("speed_kmh") * 100
    return t.pings.select(
        "ping_id",
        F.round(geo.destination_lat(lat, bearing, km), 6).alias("lat"),
        F.round(geo.destination_lon(lat, lon, bearing, km), 6).alias("lon"),
    )


@query(
    "epoch_times",
    """SELECT event_id, epoch_ms(ts) AS ms, make_timestamp_ms(epoch_ms(ts)) AS back,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.') || strftime(ts, '%g') || '+00:00' AS iso FROM ev""",
    ("ev",),
)
def epoch_times(t: DriverTables) -> DataFrame:
    ms = times.to_epoch_ms(F.col("ts"))
    return t.events.select(
        "event_id",
        ms.alias("ms"),
        times.from_epoch_ms(ms).alias("back"),
        times.iso_utc(F.col("ts")).alias("iso"),
    )


@query(
    "driver_tiers",
    """SELECT o_custkey, count(*) AS n, CASE WHEN count(*) >= 30 THEN 'gold' WHEN count(*) >= 10 THEN 'silver' ELSE 'bronze' END AS tier
  FROM orders GROUP BY 1""",
)
def driver_tiers(t: DriverTables) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        t.table("orders").groupBy("o_custkey").agg(n.alias("n"), rides.driver_tier(n).alias("tier"))
    )


@query(
    "scalar_expressions",
    """SELECT event_id, nullif(k, 50) AS not_fifty, coalesce(nullif(k, 50), -1) AS known, least(k, 60) AS low, greatest(k, 40) AS high,
  CAST(floor(value / 5) AS BIGINT) AS down, CAST(ceil(value / 5) AS BIGINT) AS up, event_type || '/' || k AS label,
  nullif(k, 50) IS DISTINCT FROM k AS differs, k BETWEEN 20 AND 30 AS inside, event_type IN ('view', 'click') AS listed FROM ev""",
    ("ev",),
)
def scalar_expressions(t: DriverTables) -> DataFrame:
    k, value = F.col("k"), F.col("value")
    some = F.nullif(k, F.lit(50))
    return t.events.select(
        "event_id",
        some.alias("not_fifty"),
        F.coalesce(some, F.lit(-1)).alias("known"),
        F.least(k, F.lit(60)).alias("low"),
        F.greatest(k, F.lit(40)).alias("high"),
        F.floor(value / 5).alias("down"),
        F.ceil(value / 5).alias("up"),
        F.concat_ws("/", "event_type", "k").alias("label"),
        (~some.eqNullSafe(k)).alias("differs"),
        k.between(20, 30).alias("inside"),
        F.col("event_type").isin("view", "click").alias("listed"),
    )


@query(
    "time_expressions",
    """SELECT event_id, date_trunc('hour', ts) AS hour_start, date_trunc('minute', ts) AS minute_start,
  date_sub('second', TIMESTAMP '2024-01-10 12:00:00', ts) AS whole_sec, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1000000.0::DOUBLE / 60.0::DOUBLE AS minutes_in,
  ts - INTERVAL 3 HOUR AS earlier, strftime(ts, '%Y%m%d%H%M%S%g') AS stamp FROM ev""",
    ("ev",),
)
def time_expressions(t: DriverTables) -> DataFrame:
    ts = F.col("ts")
    origin = F.lit("2024-01-01 00:00:00").cast("timestamp")
    noon = F.lit("2024-01-10 12:00:00").cast("timestamp")
    return t.events.select(
        "event_id",
        F.date_trunc("HOUR", ts).alias("hour_start"),
        F.date_trunc("MINUTE", ts).alias("minute_start"),
        times.whole_seconds(noon, ts).alias("whole_sec"),
        ((F.unix_micros(ts) - F.unix_micros(origin)) / F.lit(1_000_000.0) / 60.0).alias("minutes_in"),
        (ts - times.seconds(3 * 3600)).alias("earlier"),
        F.date_format(ts, "yyyyMMddHHmmssSSS").alias("stamp"),
    )


@query(
    "clamped_difference",
    """SELECT ride_id, CASE WHEN t1 IS NOT NULL AND t2 IS NOT NULL THEN greatest(epoch_ms(t2) - epoch_ms(t1), 0) / 1000.0::DOUBLE END AS sec
  FROM folded""",
    ("folded",),
)
def clamped_difference(t: DriverTables) -> DataFrame:
    kind = F.col("event_type")
    newest = F.max_by(F.col("event_ts"), F.col("kafka_offset"))
    per_type = t.ride_events.groupBy("ride_id", "event_type").agg(newest.alias("at"))
    slots = per_type.groupBy("ride_id").agg(
        F.max(F.when(kind == "requested", F.col("at"))).alias("t1"),
        F.max(F.when(kind == "matched", F.col("at"))).alias("t2"),
    )
    return slots.select("ride_id", times.elapsed_sec(F.col("t2"), F.col("t1")).alias("sec"))


@query(
    "late_arrival_flag",
    "SELECT event_id, coalesce(CASE WHEN k % 7 <> 0 THEN value * 100 END > 600, false) AS is_late FROM ev",
    ("ev",),
)
def late_arrival_flag(t: DriverTables) -> DataFrame:
    seconds = F.when(F.col("k") % 7 != 0, F.col("value") * 100)
    return t.events.select("event_id", rides.late_arrival(seconds).alias("is_late"))


@query(
    "dead_letter_filter",
    """SELECT kafka_partition AS partition, count(*) AS n FROM ride_events
  WHERE k % 13 <= 3 AND NOT (k % 13 = 0) AND kafka_offset > 1000 GROUP BY 1""",
    ("ride_events",),
)
def dead_letter_filter(t: DriverTables) -> DataFrame:
    dead = poison.envelopes(poison.decode_ride_events(t.wire), "sink", _failed_at())
    kept = dead.where(F.expr("error NOT LIKE '%frame%' AND offset > 1000"))
    return kept.groupBy("partition").agg(F.count(F.lit(1)).alias("n"))
