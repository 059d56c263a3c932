"""Streaming jobs and the archive, run over the driver's tables in the shared work folder."""

from __future__ import annotations

import math
import time
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.checks.analytics import (
    EXTRA,
    FACT,
    FACT_USES,
    INGESTED,
    LATE_SQL,
    METRICS,
    PAID_SQL,
    PING_ORDER,
    RIDE_USES,
    SESSION_SQL,
    SHIFTS,
    TIMES,
    UNPAID_SQL,
)
from fareflow.checks.registry import query
from fareflow.checks.sessions import SESSION_COLUMNS, rounded
from fareflow.checks.sources import EVENT_COLUMNS
from fareflow.operators import poison, upsert
from fareflow.plans import marts
from fareflow.plans.build import Marts, MartStore
from fareflow.session import work_dir
from fareflow.sources.derived import (
    CTES,
    DriverTables,
    numbered_events,
    to_payments,
    to_pings,
    to_ride_events,
    to_wire,
)
from fareflow.sources.buckets import BucketedTable
from fareflow.sources.lake import Lake
from fareflow.sources.versions import KeyedTable, VersionedTable
from fareflow.streaming import jobs
from fareflow.streaming.commits import BatchTables
from fareflow.streaming.feed import RideFeed
from fareflow.streaming.progress import ProgressLog, row_counters
from fareflow.streaming.sessionizer import sessionize
from fareflow.streaming.sources import file_stream


FILES = 4
#: Rows of one file of a stream, about: a batch of more lies in several, which tasks read side by side.
FILE_ROWS = 100_000


#: Order of arrival of the driver's events, and the batch of an arrival when it is cut evenly.
ARRIVAL = "event_id + (event_id * 7919) % 97"


def _stream(t: DriverTables, by: str = "ts", files: int = FILES) -> DataFrame:
    """The whole events table as a file stream of ``files`` micro-batches, in order of ``by`` or, evenly, of arrival.

    In order of time each batch follows the one before, so nothing is late; in order of ``event_id`` every batch
    spans the whole time. A batch lies in as many files as its rows need, the same number for each batch.
    """
    events = t.spark.read.parquet(f"{t.sf_dir}/events.parquet")
    folder = work_dir(t.spark, "events")
    width = max(1, math.ceil(events.count() / (files * FILE_ROWS)))
    if by == ARRIVAL:
        last = events.agg(F.max(F.expr(ARRIVAL))).scalar()
        parts = events.withColumn("part", F.floor(F.expr(ARRIVAL) * files / (last + 1)).cast("int"))
    else:
        ranges = events.repartitionByRange(files * width, by)
        parts = ranges.withColumn("part", F.floor(F.spark_partition_id() / width).cast("int"))
    parts.write.partitionBy("part").parquet(f"{folder}/parts")
    written = t.spark.read.schema(parts.schema).parquet(f"{folder}/parts")
    for n in range(files):  # one batch's files after the other's, since a file stream goes by their age
        one = written.where(F.col("part") == n).drop("part")
        one.repartition(width).write.mode("append").parquet(f"{folder}/in")
        # Fewer rows than files leave some out; empty ones keep the batches' borders.
        there = len(t.spark.read.schema(events.schema).parquet(f"{folder}/in").inputFiles())
        for _ in range((n + 1) * width - there):
            one.limit(0).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    raw = file_stream(t.spark, f"{folder}/in", events.schema, max_files=width)
    return numbered_events(raw.withColumn("ts", F.col("ts").cast("timestamp")))


def _run(t: DriverTables, stream: DataFrame, name: str) -> DataFrame:
    return jobs.run_to_table(stream, work_dir(t.spark, name))


def _copied_sessions(t: DriverTables) -> DataFrame:
    """Sessions written to the work folder and read back as a stream."""
    folder = work_dir(t.spark, "sessions")
    t.sessions.write.parquet(folder)
    return file_stream(t.spark, folder, t.sessions.schema)


@query("stream_events", f"SELECT {EVENT_COLUMNS} FROM ride_events WHERE k % 13 > 3", ("ride_events",))
def stream_events(t: DriverTables) -> DataFrame:
    """File source, frame decode, clean rows."""
    wire = to_wire(to_ride_events(_stream(t)))
    clean = poison.clean_rows(poison.decode_ride_events(wire)).drop("kafka_partition", "kafka_offset")
    return _run(t, clean, "events")


@query("stream_locations", "SELECT * FROM pings", ("pings",))
def stream_locations(t: DriverTables) -> DataFrame:
    return _run(t, to_pings(_stream(t)), "locations")


@query(
    "stream_city_metrics",
    "SELECT * FROM metrics WHERE window_end <= (SELECT max(event_ts) FROM ride_events) - INTERVAL 30 SECOND",
    RIDE_USES,
    METRICS,
)
def stream_city_metrics(t: DriverTables) -> DataFrame:
    """Windows the watermark has passed; the newest stay open."""
    return _run(t, jobs.city_metrics_stream(to_ride_events(_stream(t))), "city-metrics")


@query(
    "stream_ping_sessions",
    f"SELECT * FROM ({SESSION_SQL}) WHERE session_end <= (SELECT max(ts) FROM pings) - INTERVAL 30 SECOND",
    ("pings",),
    SHIFTS,
)
def stream_ping_sessions(t: DriverTables) -> DataFrame:
    return _run(t, jobs.ping_sessions_stream(to_pings(_stream(t))), "ping-sessions")


@query("stream_stateful_sessions", f"SELECT {SESSION_COLUMNS} FROM sessions", ("sessions",))
def stream_stateful_sessions(t: DriverTables) -> DataFrame:
    """The sessionizer with Spark's own state and watermark.

    Rides here last for days, so a batch border would time them out; one batch is what the fold equals.
    Borders, late rows and restarts are tested on rides of real length.
    """
    rows = _run(t, sessionize(to_ride_events(_stream(t, files=1))), "sessionizer")
    return rounded(rows, "haversine_distance_km", "avg_speed_kmh")


@query(
    "stream_state_audit",
    """SELECT (SELECT count(DISTINCT ride_id) FROM ride_events) AS n_rides, count(*) AS n_closed, count(*) AS n_sessions,
  (SELECT count(DISTINCT ride_id) FROM ride_events) - count(*) AS n_open FROM sessions""",
    ("ride_events", "sessions"),
)
def stream_state_audit(t: DriverTables) -> DataFrame:
    """The sessionizer's state store, read back: a mark for every closed ride, the open ones beside, and a session for each mark."""
    folder = work_dir(t.spark, "state")
    sessions = jobs.run_to_table(sessionize(to_ride_events(_stream(t, files=1))), folder)
    kept = [
        t.spark.read.format("statestore").option("stateVarName", name).load(f"{folder}/checkpoint").select(F.lit(name).alias("kind"))
        for name in ("open", "closed")
    ]
    marks = reduce(DataFrame.unionByName, kept).agg(
        F.count(F.lit(1)).alias("n_rides"),
        F.count_if(F.col("kind") == "closed").alias("n_closed"),
        F.count_if(F.col("kind") == "open").alias("n_open"),
    )
    return marks.withColumn("n_sessions", sessions.agg(F.count(F.lit(1)).alias("n")).scalar())


@query(
    "stream_progress",
    f"""SELECT b AS number, count(*) AS n_rows, CAST(sum(count(*)) OVER (ORDER BY b) AS BIGINT) AS total FROM (SELECT
  CAST(floor(({ARRIVAL}) * {FILES} / (SELECT max({ARRIVAL}) + 1 FROM events)) AS BIGINT) AS b FROM events) GROUP BY b""",
)
def stream_progress(t: DriverTables) -> DataFrame:
    """Rows that a running query reports for each micro-batch, and so far."""
    log = ProgressLog()
    t.spark.streams.addListener(log)
    try:
        _run(t, to_ride_events(_stream(t, by=ARRIVAL)).select("event_id"), "progress")
        until = time.monotonic() + 30
        while len(log.waiting) < FILES and time.monotonic() < until:  # events reach a listener after the query's end
            time.sleep(0.1)
    finally:
        t.spark.streams.removeListener(log)
    counted = row_counters(log.drained(t.spark))
    return counted.where("n_rows > 0").select("number", "n_rows", "total")


@query("stream_ride_payments", PAID_SQL, ("sessions", "payments"), TIMES)
def stream_ride_payments(t: DriverTables) -> DataFrame:
    stream = jobs.ride_payments_stream(_copied_sessions(t), to_payments(_stream(t)))
    return _run(t, stream, "ride-payments")


@query(
    "stream_unpaid_rides",
    f"""SELECT * FROM ({UNPAID_SQL}) WHERE ended_ts + INTERVAL 15 MINUTE < (SELECT least((SELECT max(session_ts) FROM session_times),
  (SELECT max(payment_ts) FROM payments))) - INTERVAL 30 SECOND""",
    ("sessions", "payments"),
    {"session_times": EXTRA["session_times"]},
)
def stream_unpaid_rides(t: DriverTables) -> DataFrame:
    """Rides whose bound the watermark has passed with no payment."""
    stream = jobs.unpaid_rides_stream(_copied_sessions(t), to_payments(_stream(t)))
    return _run(t, stream, "unpaid-rides")


@query("stream_dedup", "SELECT DISTINCT event_id FROM ride_events", ("ride_events",))
def stream_dedup(t: DriverTables) -> DataFrame:
    """One row per event id, over batches that each span the whole time: no id is lost behind a watermark."""
    folder = work_dir(t.spark, "dedup")
    events = to_ride_events(_stream(t, by="event_id")).select("event_id", "event_ts")
    table = BucketedTable(t.spark, f"{folder}/table", events.schema, ["event_id"], buckets=16)
    write = jobs.insert_batch(table, [F.col("event_ts")], f"{folder}/checkpoint")
    jobs.start(events, f"{folder}/checkpoint", foreach_batch=write).awaitTermination()
    return table.read().select("event_id")


@query(
    "stream_match_histogram",
    "SELECT * FROM hist WHERE window_end <= (SELECT max(session_ts) FROM session_times WHERE time_to_match_sec IS NOT NULL) - INTERVAL 30 SECOND",
    RIDE_USES,
    METRICS,
)
def stream_match_histogram(t: DriverTables) -> DataFrame:
    """Histogram windows the watermark has passed; it follows the rows that have a time to match."""
    return _run(t, jobs.match_histogram_stream(_copied_sessions(t)), "match-histogram")


def _split(t: DriverTables, checkpoints: int = 1) -> BatchTables:
    folder = work_dir(t.spark, "split")
    tables = BatchTables(t.spark, f"{folder}/tables", "sink")
    wire = to_wire(to_ride_events(_stream(t))).drop("k")
    for n in range(checkpoints):
        at = f"{folder}/checkpoint-{n}"
        jobs.start(wire, at, foreach_batch=jobs.split_batch(tables, at)).awaitTermination()
    return tables


@query("stream_split_clean", f"SELECT {EVENT_COLUMNS} FROM ride_events WHERE k % 13 > 3", ("ride_events",))
def stream_split_clean(t: DriverTables) -> DataFrame:
    return _split(t).read("clean").drop("batch", "kafka_partition", "kafka_offset")


@query(
    "stream_split_ledger",
    """SELECT 'sink' AS consumer_group, 'rides.events' AS topic, kafka_partition AS partition, max(kafka_offset) AS kafka_offset,
  count(*) FILTER (k % 13 <= 3) AS n_dead FROM ride_events GROUP BY kafka_partition""",
    ("ride_events",),
)
def stream_split_ledger(t: DriverTables) -> DataFrame:
    """Positions cover poison too, and the dead letters lie beside them."""
    tables = _split(t)
    letters = tables.read("dead").groupBy("partition").agg(F.count(F.lit(1)).alias("n_dead"))
    return tables.ledger().join(letters, "partition").select(
        "consumer_group", "topic", "partition", "kafka_offset", "n_dead"
    )


@query(
    "sink_after_new_checkpoint",
    f"""SELECT *, 2 AS n FROM (SELECT {EVENT_COLUMNS} FROM ride_events WHERE k % 13 > 3)""",
    ("ride_events",),
)
def sink_after_new_checkpoint(t: DriverTables) -> DataFrame:
    """Two queries with checkpoints of their own fill one table: neither's batches replace the other's."""
    rows = _split(t, checkpoints=2).read("clean").drop("batch", "kafka_partition", "kafka_offset")
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("int").alias("n"))


# --- late rows and the feed --------------------------------------------------------------------


@query("stream_late_events", f"SELECT *, CAST(2 * count(*) AS INTEGER) AS n FROM ({LATE_SQL}) GROUP BY ALL", ("ride_events",))
def stream_late_events(t: DriverTables) -> DataFrame:
    """Rows behind their partition's watermark, over four batches in order of arrival; a second checkpoint adds its own."""
    folder = work_dir(t.spark, "late")
    events = to_ride_events(_stream(t, by=ARRIVAL))
    for n in range(2):
        at = f"{folder}/checkpoint-{n}"
        late = jobs.LateOutput(t.spark, f"{folder}/late", at)
        jobs.start(events, at, foreach_batch=late).awaitTermination()
    rows = late.read()
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("int").alias("n"))


#: The feed's rides in SQL: in which of four batches a ride closes, and the fold of its events up to that batch.
FEED = {
    "fed": f"""SELECT *, CAST(floor(({ARRIVAL.replace('event_id', 'source_id')}) * {FILES} / (SELECT max({ARRIVAL.replace('event_id', 'source_id')}) + 1 FROM ride_events)) AS INTEGER) AS b
  FROM ride_events""",
    "fed_clean": "SELECT * FROM fed WHERE k % 13 > 3",
    "as_of": f"""SELECT e.*, u AS upto, row_number() OVER (PARTITION BY ride_id, event_type, u ORDER BY kafka_offset DESC) AS rn
  FROM fed_clean e JOIN range({FILES}) AS upto(u) ON b <= u""",
    "ride_as_of": """SELECT ride_id, kafka_partition, upto, max(event_ts) FILTER (rn = 1) AS last_ts,
  bool_or(event_type IN ('completed', 'cancelled')) AS ended FROM as_of GROUP BY ride_id, kafka_partition, upto""",
    "partition_as_of": """SELECT kafka_partition, upto, max(event_ts) AS newest, bool_or(b = upto) AS has_input
  FROM as_of GROUP BY kafka_partition, upto""",
    "closing": """SELECT ride_id, min(upto) AS closed_in FROM ride_as_of JOIN partition_as_of USING (kafka_partition, upto)
  WHERE ended OR (has_input AND newest > last_ts + INTERVAL 2 HOUR) GROUP BY ride_id""",
    "fed_events": "SELECT e.* FROM fed_clean e JOIN closing USING (ride_id) WHERE b <= closed_in",
    "fed_slots": CTES["slots"].replace("ride_events", "fed_events"),
    "fed_folded": CTES["folded"].replace("slots", "fed_slots"),
    "fed_timed": CTES["timed"].replace("FROM folded", "FROM fed_folded"),
    "fed_sessions": CTES["sessions"].partition("WHERE")[0].replace("FROM timed", "FROM fed_timed"),
}


class Interrupted(RuntimeError):
    """A job that is lost on purpose."""


class FragileTables(BatchTables):
    """Tables whose writer is lost once before, and once after, a batch's ledger entry is written."""

    def __init__(self, spark: SparkSession, root: str, consumer_group: str) -> None:
        super().__init__(spark, root, consumer_group)
        self.losses = [("1", "before"), ("2", "after")]

    def commit(self, batch: str, entry: DataFrame) -> None:
        when = [w for n, w in self.losses if batch.endswith(f"-{n}")]
        self.losses = [loss for loss in self.losses if not batch.endswith(f"-{loss[0]}")]
        if when == ["before"]:
            raise Interrupted(batch)
        super().commit(batch, entry)
        if when == ["after"]:
            raise Interrupted(batch)


def _feed(t: DriverTables, tables: type[BatchTables] = BatchTables, runs: int = 1) -> BatchTables:
    """The feed over four batches in order of arrival, started again on its checkpoint after each loss."""
    folder = work_dir(t.spark, "feed")
    feed = RideFeed(t.spark, f"{folder}/tables", f"{folder}/checkpoint")
    feed.tables = tables(t.spark, f"{folder}/tables", "sessionizer")
    wire = to_wire(to_ride_events(_stream(t, by=ARRIVAL))).drop("k")
    for n in range(runs):
        query = jobs.start(wire, f"{folder}/checkpoint", foreach_batch=feed)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if n == runs - 1:
                raise
    return feed.tables


@query("stream_sessions", f"SELECT {SESSION_COLUMNS} FROM fed_sessions", ("ride_events",), FEED)
def stream_sessions(t: DriverTables) -> DataFrame:
    """Sessions of the feed over four batches, timeouts by each partition's own watermark included."""
    rows = _feed(t).read("sessions").drop("batch")
    return rounded(rows, "haversine_distance_km", "avg_speed_kmh")


@query(
    "stream_feed_accounts",
    """SELECT kafka_partition, count(*) AS n_messages, count(*) FILTER (k % 13 <= 3) AS n_letters,
  count(*) FILTER (k % 13 > 3) AS n_mirror, count(*) FILTER (k % 13 > 3 AND b > closed_in) AS n_ignored,
  count(DISTINCT ride_id) FILTER (k % 13 > 3 AND closed_in IS NOT NULL) AS n_sessions,
  count(DISTINCT ride_id) FILTER (k % 13 > 3 AND closed_in IS NULL) AS n_open, max(kafka_offset) AS kafka_offset
  FROM fed LEFT JOIN closing USING (ride_id) GROUP BY kafka_partition""",
    ("ride_events",),
    FEED,
)
def stream_feed_accounts(t: DriverTables) -> DataFrame:
    """Every message is in one place: a letter, a row of a session or open ride, or a row that came after its ride closed."""
    tables = _feed(t)
    mirror = tables.read("mirror").select("ride_id", "kafka_partition")
    at = mirror.distinct()
    newest = tables.last_batch(tables.entries().agg(F.max("stream")).first()[0], 2**31)

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("kafka_partition").agg(F.count(F.lit(1)).alias(name))

    letters = tables.read("letters").select(F.col("partition").alias("kafka_partition"))
    parts = [
        counted(mirror, "n_mirror"),
        counted(letters, "n_letters"),
        counted(tables.read("ignored"), "n_ignored"),
        counted(tables.read("sessions").join(at, "ride_id"), "n_sessions"),
        counted(tables.read("open").where(F.col("batch") == newest), "n_open"),
        tables.ledger().select(F.col("partition").alias("kafka_partition"), "kafka_offset"),
    ]
    rows = reduce(lambda a, b: a.join(b, "kafka_partition", "left"), parts).na.fill(0)
    return rows.withColumn("n_messages", F.col("n_mirror") + F.col("n_letters"))


@query("stream_resume", f"SELECT {SESSION_COLUMNS} FROM fed_sessions", ("ride_events",), FEED)
def stream_resume(t: DriverTables) -> DataFrame:
    """The feed, lost once between a batch's rows and its ledger entry and once right after the entry, and started again."""
    rows = _feed(t, FragileTables, runs=3).read("sessions").drop("batch")
    return rounded(rows, "haversine_distance_km", "avg_speed_kmh")


# --- archive -----------------------------------------------------------------------------------


@query(
    "lake_inventory",
    """SELECT strftime(event_ts, '%Y-%m-%d') AS event_day, city_id, count(*) AS rows FROM ride_events GROUP BY 1, 2""",
    ("ride_events",),
)
def lake_inventory(t: DriverTables) -> DataFrame:
    lake = Lake(t.spark, work_dir(t.spark, "lake"))
    lake.append(t.ride_events, "all")
    return lake.inventory().select(F.col("event_day").cast("string"), "city_id", "rows")


@query(
    "lake_null_partition",
    """SELECT event_day, city_id, count(*) AS n, count(DISTINCT event_id) AS n_ids FROM (SELECT event_id, nullif(city_id, 3) AS city_id,
  CASE WHEN source_id % 5 > 0 THEN strftime(event_ts, '%Y-%m-%d') END AS event_day FROM ride_events) GROUP BY 1, 2""",
    ("ride_events",),
)
def lake_null_partition(t: DriverTables) -> DataFrame:
    """Rows without a partition value are stored, rewritten, compacted and read like the others."""
    rows = t.ride_events.select(
        "event_id",
        F.when(F.col("source_id") % 5 > 0, F.date_format("event_ts", "yyyy-MM-dd")).alias("event_day"),
        F.nullif(F.col("city_id"), F.lit(3)).alias("city_id"),
    )
    table = VersionedTable(t.spark, work_dir(t.spark, "lake"), rows.schema, ["event_day", "city_id"])
    for n in range(2):
        table.append(rows.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == n), f"half-{n}")
    table.rewrite(rows.where("city_id is null").select("event_day", "city_id").distinct(), lambda old: old, "again")
    table.compact(min_files=1)
    return table.read().groupBy("event_day", "city_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_ids")
    )


@query(
    "lake_schema_evolution",
    """SELECT payload_version, is_synthetic, count(*) AS n, count(CASE WHEN payload_version = 2 THEN promo_code END) AS n_promo
  FROM (SELECT *, true AS is_synthetic FROM ride_events) GROUP BY 1, 2""",
    ("ride_events",),
)
def lake_schema_evolution(t: DriverTables) -> DataFrame:
    """Version-1 rows first, then version 2: the column appears once and old rows read null."""
    lake = Lake(t.spark, work_dir(t.spark, "lake"))
    events = t.ride_events
    lake.append(events.where("payload_version = 1"), "v1")
    lake.append(events.where("payload_version = 2"), "v2")
    return lake.read().groupBy("payload_version", "is_synthetic").agg(
        F.count(F.lit(1)).alias("n"), F.count("promo_code").alias("n_promo")
    )


@query(
    "lake_time_travel",
    """SELECT 1 AS as_of, city_id, count(*) AS n FROM ride_events WHERE source_id % 2 = 0 GROUP BY 2 UNION ALL
  SELECT 2, city_id, count(*) FROM ride_events GROUP BY 2""",
    ("ride_events",),
)
def lake_time_travel(t: DriverTables) -> DataFrame:
    lake = Lake(t.spark, work_dir(t.spark, "lake"))
    events = t.ride_events
    first = lake.append(events.where("source_id % 2 = 0"), "even")
    second = lake.append(events.where("source_id % 2 = 1"), "odd")

    def per_city(snapshot: int) -> DataFrame:
        return (
            lake.read(snapshot)
            .groupBy("city_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(snapshot).cast("int").alias("as_of"), "city_id", "n")
        )

    return per_city(first).unionByName(per_city(second))


@query(
    "lake_compaction",
    """SELECT event_id, event_ts, city_id, fare_cents, promo_code FROM ride_events""",
    ("ride_events",),
)
def lake_compaction(t: DriverTables) -> DataFrame:
    """Two small batches, compacted: the rows stay the same."""
    lake = Lake(t.spark, work_dir(t.spark, "lake"))
    for n in range(2):
        lake.append(t.ride_events.where(f"source_id % 2 = {n}"), f"part-{n}")
    lake.compact(min_files=1)
    return lake.read().select("event_id", "event_ts", "city_id", "fare_cents", "promo_code")


# --- keyed tables ------------------------------------------------------------------------------


def _orders_by_month(t: DriverTables) -> DataFrame:
    return t.table("orders").select(
        "o_custkey",
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        "o_orderdate",
    )


def _keyed(t: DriverTables, rows: DataFrame) -> KeyedTable:
    return KeyedTable(t.spark, work_dir(t.spark, "keyed"), rows.schema, ["month"], ["o_custkey"])


@query(
    "keyed_table_insert",
    """SELECT o_custkey, o_orderkey, month FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS month, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderkey % 2, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def keyed_table_insert(t: DriverTables) -> DataFrame:
    """First order per customer: two batches, the second only adds customers it brings anew."""
    rows = _orders_by_month(t)
    table = _keyed(t, rows)
    order = [F.col("o_orderkey")]
    table.insert(rows.where("o_orderkey % 2 = 0"), "even", order)
    table.insert(rows.where("o_orderkey % 2 = 1"), "odd", order)
    return table.read().drop("o_orderdate")


@query(
    "bucketed_table_insert",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 2, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""",
)
def bucketed_table_insert(t: DriverTables) -> DataFrame:
    """First order per customer, in buckets of the customer; a batch that comes again adds nothing."""
    rows = t.table("orders").select("o_custkey", "o_orderkey")
    table = BucketedTable(t.spark, work_dir(t.spark, "buckets"), rows.schema, ["o_custkey"], buckets=16)
    for name in ("even", "odd", "odd"):
        half = rows.where(F.col("o_orderkey") % 2 == int(name == "odd"))
        table.insert(half, name, [F.col("o_orderkey")])
    return table.read()


@query(
    "keyed_table_merge",
    """SELECT o_custkey, o_orderkey, month FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS month, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate >= TIMESTAMP '2001-01-01' DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def keyed_table_merge(t: DriverTables) -> DataFrame:
    """A late batch replaces its customers' rows and rewrites only the months it touches."""
    rows = _orders_by_month(t)
    table = _keyed(t, rows)
    order = [F.col("o_orderkey")]
    late = F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp")
    table.insert(rows.where(~late), "first", order)
    table.merge(
        rows.where(late),
        "late",
        lambda old, new: upsert.upsert_last(old, new, ["o_custkey"], order),
    )
    return table.read().drop("o_orderdate")


# --- a whole run of the marts --------------------------------------------------------------------


def _marts(t: DriverTables) -> Marts:
    """Two runs, the second with newer rides. The runs read what has landed, so the events are parsed once for each table."""
    at = F.lit(INGESTED).cast("timestamp")
    folder = work_dir(t.spark, "marts")

    def landed(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/landed/{name}")
        return t.spark.read.schema(rows.schema).parquet(f"{folder}/landed/{name}")

    sessions = landed(marts.with_ingest_time(t.sessions, at), "sessions")
    payments, pings = landed(t.payments, "payments"), landed(t.pings, "pings")
    store = MartStore(t.spark, folder)
    early = sessions.where(F.col("requested_ts") < F.lit("2024-01-20").cast("timestamp"))
    store.run("1", at, early, payments, pings, t.cities, PING_ORDER)
    return store.run("2", at, sessions, payments, pings, t.cities, PING_ORDER)


@query("mart_build", "SELECT * FROM hourly", FACT_USES, FACT)
def mart_build(t: DriverTables) -> DataFrame:
    """The rollup after two runs equals one made from everything at once."""
    return rounded(_marts(t).agg_city_hourly, "p50_time_to_match_sec", "p95_time_to_match_sec")


#: Rows and one total of each mart after the two runs. A driver whose tier the newer rides changed has two versions; each run
#: writes seven quality results, of which uniqueness fails where a ride was paid twice.
MARTS = {
    "tiers": """SELECT driver_id, CASE WHEN n >= 30 THEN 'gold' WHEN n >= 10 THEN 'silver' ELSE 'bronze' END AS tier,
    CASE WHEN early >= 30 THEN 'gold' WHEN early >= 10 THEN 'silver' ELSE 'bronze' END AS tier_before
  FROM (SELECT p.driver_id, count(s.ride_id) AS n, count(s.ride_id) FILTER (s.requested_ts < TIMESTAMP '2024-01-20') AS early
    FROM (SELECT DISTINCT driver_id FROM pings) p LEFT JOIN sessions s ON s.driver_id = p.driver_id AND s.terminal_state = 'completed' GROUP BY 1)""",
    "twice": "SELECT ride_id, min(requested_at) AS requested_at FROM enriched GROUP BY ride_id HAVING count(*) > 1",
}
MART_SQL = """SELECT 'fct_rides' AS mart, count(*) AS n_rows, CAST(sum(fare_cents) AS BIGINT) AS total FROM enriched
UNION ALL SELECT 'agg_city_hourly', count(*), CAST(sum(rides_closed) AS BIGINT) FROM hourly
UNION ALL SELECT 'fct_driver_shifts', count(*), CAST(sum(ping_count) AS BIGINT) FROM shifts
UNION ALL SELECT 'dim_cities', count(*), CAST(sum(city_id) AS BIGINT) FROM cities
UNION ALL SELECT 'dim_drivers', count(*) + count(*) FILTER (tier <> tier_before), count(*) FROM tiers
UNION ALL SELECT 'dq_results', 14, 14 - CAST(count(*) > 0 AS BIGINT) - CAST(count(*) FILTER (requested_at < TIMESTAMP '2024-01-20') > 0 AS BIGINT) FROM twice"""


@query("mart_tables", MART_SQL, (*FACT_USES, "pings"), {**FACT, **SHIFTS, **MARTS})
def mart_tables(t: DriverTables) -> DataFrame:
    """Rows and a total of all six marts after two runs."""
    built = _marts(t)
    totals = {
        "fct_rides": F.sum("fare_cents"),
        "agg_city_hourly": F.sum("rides_closed"),
        "fct_driver_shifts": F.sum("ping_count"),
        "dim_cities": F.sum("city_id"),
        "dim_drivers": F.count_if("is_current"),
        "dq_results": F.count_if("success"),
    }
    parts = [
        getattr(built, name).agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n_rows"), total.cast("long").alias("total"))
        for name, total in totals.items()
    ]
    return reduce(DataFrame.unionByName, parts)
