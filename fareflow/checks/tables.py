"""Upserts, incremental loads, dimensions, quality and operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.checks.analytics import FACT, FACT_USES, INGESTED, _fact
from fareflow.checks.registry import query
from fareflow.checks.sources import SEED_SQL, seeded_cities
from fareflow.checks.sessions import rounded
from fareflow.operators import offsets, ops, poison, quality, quantiles, scd2, upsert
from fareflow.plans import contracts, dashboards, marts
from fareflow.schemas import EVENT_ORDINALS, LANDED_EVENT_COLUMNS
from fareflow.sources.derived import DriverTables


def ts_lit(text: str):
    return F.lit(text).cast("timestamp")


# --- upserts ---------------------------------------------------------------------------------


@query(
    "upsert_first_wins",
    """SELECT ride_id, event_type, source_id FROM (SELECT *, row_number() OVER (PARTITION BY ride_id, event_type
  ORDER BY source_id % 2, kafka_offset) AS rn FROM ride_events) WHERE rn = 1""",
    ("ride_events",),
)
def upsert_first_wins(t: DriverTables) -> DataFrame:
    """Landed ride events (even sources) take a batch (odd ones) keyed on ride and ordinal."""
    keys, order = ["ride_id", "event_type"], [F.col("kafka_offset")]
    rows = t.ride_events.select("ride_id", "event_type", "source_id", "kafka_offset")
    empty = rows.where(F.lit(False))
    landed = upsert.upsert_first(empty, rows.where("source_id % 2 = 0"), keys, order)
    merged = upsert.upsert_first(landed, rows.where("source_id % 2 = 1"), keys, order)
    return merged.select("ride_id", "event_type", "source_id")


@query(
    "upsert_richer_wins",
    """SELECT a.ride_id, a.rider_id, a.event_ts AS requested_ts, b.k AS event_seq, b.fare_cents, b.promo_code FROM
  (SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY source_id % 2, CASE WHEN source_id % 2 = 0 THEN 0 ELSE kafka_offset END) AS rn FROM kept) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY k DESC, source_id % 2, kafka_offset) AS rn FROM kept) b
  ON a.ride_id = b.ride_id AND a.rn = 1 AND b.rn = 1""",
    ("ride_events",),
    {
        "kept": """SELECT * EXCLUDE (e) FROM (SELECT *, row_number() OVER (PARTITION BY ride_id, source_id % 2 ORDER BY kafka_offset) AS e
  FROM ride_events) WHERE source_id % 2 = 1 OR e = 1"""
    },
)
def upsert_richer_wins(t: DriverTables) -> DataFrame:
    from fareflow.operators.latest import first_per_key

    rows = t.ride_events.select(
        "ride_id",
        "rider_id",
        F.col("event_ts").alias("requested_ts"),
        F.col("k").alias("event_seq"),
        "fare_cents",
        "promo_code",
        F.col("kafka_offset").alias("arrival"),
        "source_id",
    )
    existing = first_per_key(rows.where("source_id % 2 = 0"), ["ride_id"], [F.col("arrival")])
    return upsert.upsert_richer(
        existing.drop("arrival", "source_id"), rows.where("source_id % 2 = 1").drop("source_id")
    )


@query(
    "upsert_last_wins",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderkey % 2 DESC, o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def upsert_last_wins(t: DriverTables) -> DataFrame:
    """Latest order per customer: even orders are in the table, odd ones come as a batch."""
    orders = t.table("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    empty = orders.where(F.lit(False))
    table = upsert.upsert_last(empty, orders.where("o_orderkey % 2 = 0"), ["o_custkey"], order)
    merged = upsert.upsert_last(table, orders.where("o_orderkey % 2 = 1"), ["o_custkey"], order)
    return merged.drop("o_orderdate")


def _messages(t: DriverTables) -> DataFrame:
    return t.wire.select("topic", "partition", "offset")


@query(
    "offset_ledger",
    """SELECT 'sink' AS consumer_group, 'rides.events' AS topic, kafka_partition AS partition, max(kafka_offset) AS kafka_offset
  FROM ride_events GROUP BY kafka_partition""",
    ("ride_events",),
)
def offset_ledger(t: DriverTables) -> DataFrame:
    newer = offsets.batch_offsets(_messages(t), "sink")
    older = offsets.batch_offsets(_messages(t).where("offset % 2 = 0"), "sink")
    return offsets.advance_ledger(newer, older)


@query(
    "resume_after_ledger",
    """SELECT kafka_partition AS partition, kafka_offset AS "offset" FROM ride_events r WHERE kafka_partition = 3 OR kafka_offset >
  (SELECT coalesce(max(kafka_offset), -1) FROM ride_events x WHERE x.kafka_partition = r.kafka_partition AND x.source_id % 1000 = 0)""",
    ("ride_events",),
)
def resume_after_ledger(t: DriverTables) -> DataFrame:
    """Messages to read again after a stop; partition 3 was never committed."""
    rows = t.ride_events.select(
        F.lit("rides.events").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        "source_id",
    )
    ledger = offsets.batch_offsets(rows.where("source_id % 1000 = 0 AND partition <> 3"), "sink")
    return offsets.unprocessed(rows, ledger, "sink").select("partition", "offset")


# --- incremental and dimensions ----------------------------------------------------------------


@query(
    "incremental_ride_fact",
    """SELECT e.ride_id, e.requested_at, e.txn_id, CASE WHEN e.requested_at < TIMESTAMP '2024-01-20' AND e.requested_at <
  (SELECT max(requested_at) FROM enriched WHERE requested_at < TIMESTAMP '2024-01-20') - INTERVAL 60 MINUTE THEN -1 ELSE e.fare_cents END AS fare_cents
  FROM one_paid e""",
    FACT_USES,
    {**FACT, "one_paid": "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY txn_id) AS rn FROM enriched) WHERE rn = 1"},
)
def incremental_ride_fact(t: DriverTables) -> DataFrame:
    """Rides up to a day are in the fact with a stale fare; one run refreshes the last hour and adds the rest."""
    from fareflow.operators.latest import first_per_key

    source = first_per_key(_fact(t), ["ride_id"], [F.col("txn_id")])
    target = source.where(F.col("requested_at") < ts_lit("2024-01-20")).withColumn(
        "fare_cents", F.lit(-1).cast("long")
    )
    return marts.merge_fact(target, source).select("ride_id", "requested_at", "txn_id", "fare_cents")


RUNS = ("2024-01-10", "2024-01-20", "2024-01-31")


def _driver_state(t: DriverTables, until: str) -> DataFrame:
    """Per user up to a day: newest status, tier by purchases, city."""
    seen = t.events.where(F.col("ts") < ts_lit(until))
    n = F.count_if(F.col("event_type") == "purchase")
    from fareflow.functions.rides import driver_tier

    return seen.groupBy(F.concat(F.lit("d-"), "user_id").alias("driver_id")).agg(
        F.max_by("user_id", "event_id").cast("int").alias("city_id"),
        F.max_by("event_type", "event_id").alias("status"),
        driver_tier(n).alias("tier"),
        n.alias("completed_rides"),
        F.max("ts").alias("last_seen_at"),
    )


def _history(t: DriverTables) -> DataFrame:
    history = scd2.empty_history(_driver_state(t, RUNS[0]))
    for run in RUNS:
        history = scd2.scd2_merge(
            history, _driver_state(t, run), "driver_id", marts.SNAPSHOT_CHECKED, ts_lit(run)
        )
    return history


HISTORY = {
    "states": " UNION ALL ".join(
        f"""SELECT 'd-' || user_id AS driver_id, CAST(arg_max(user_id, event_id) AS INTEGER) AS city_id, arg_max(event_type, event_id) AS status,
  CASE WHEN count(*) FILTER (event_type = 'purchase') >= 30 THEN 'gold' WHEN count(*) FILTER (event_type = 'purchase') >= 10 THEN 'silver' ELSE 'bronze' END AS tier,
  count(*) FILTER (event_type = 'purchase') AS completed_rides, max(ts) AS last_seen_at, TIMESTAMP '{run}' AS run_at
  FROM ev WHERE ts < TIMESTAMP '{run}' GROUP BY user_id"""
        for run in RUNS
    ),
    "history": """SELECT driver_id, city_id, status, tier, completed_rides, last_seen_at, run_at AS valid_from,
  lead(run_at) OVER (PARTITION BY driver_id ORDER BY run_at) AS valid_to FROM (SELECT *, lag(run_at) OVER w IS NULL OR
   (lag(city_id) OVER w, lag(status) OVER w, lag(tier) OVER w) IS DISTINCT FROM (city_id, status, tier) AS opens
   FROM states WINDOW w AS (PARTITION BY driver_id ORDER BY run_at)) WHERE opens""",
}


@query("driver_history", "SELECT * FROM history", ("ev",), HISTORY)
def driver_history(t: DriverTables) -> DataFrame:
    return _history(t)


@query(
    "driver_dimension",
    """SELECT driver_id || '.' || strftime(valid_from, '%Y%m%d%H%M%S%g') AS driver_version_key, *, valid_to IS NULL AS is_current FROM history""",
    ("ev",),
    HISTORY,
)
def driver_dimension(t: DriverTables) -> DataFrame:
    return marts.dim_drivers(_history(t))


@query(
    "city_dimension",
    f"SELECT city_id, name AS city_name, center_lat, center_lon, demand_weight FROM ({SEED_SQL})",
)
def city_dimension(t: DriverTables) -> DataFrame:
    return marts.dim_cities(seeded_cities(t))


# --- quality -----------------------------------------------------------------------------------


def _landed(t: DriverTables) -> DataFrame:
    return poison.landing_rows(t.ride_events, ts_lit(INGESTED))


def _suite_sql(table: str, checks: list[tuple[str, str | None, str | None, str | None]], suite: str) -> str:
    """(expectation, column, violation condition or None, success/observed SQL) rows as a UNION."""
    rows = []
    for name, column, bad, observed in checks:
        col = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
        if bad is not None:
            n = f"count(*) FILTER ({bad})"
            rows.append(
                f"SELECT '{name}' AS expectation, {col} AS column_name, {n} = 0 AS success, count(*) AS element_count,"
                f" {n} AS unexpected_count, CAST(NULL AS VARCHAR) AS observed FROM {table}"
            )
        else:
            rows.append(
                f"SELECT '{name}', {col}, {observed.split('|')[0]}, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), {observed.split('|')[1]} FROM {table}"
            )
    return (
        f"SELECT 'run-1' AS run_id, TIMESTAMP '{INGESTED}' AS run_at, '{suite}' AS suite, *, 'warn' AS mode FROM ("
        + " UNION ALL ".join(rows)
        + ")"
    )


_N = quality.NAMES
LANDED_CHECKS = [
    *[(_N["not_null"], c, f"{c} IS NULL", None) for c in ("ride_id", "event_id", "event_type", "event_ts", "rider_id", "city_id")],
    (_N["in_set"], "event_type", "event_type NOT IN ('requested','matched','driver_arrived','started','completed','cancelled')", None),
    (_N["in_set"], "city_id", "city_id NOT IN (1, 2, 3, 4, 5)", None),
    *[(_N["between"], c, f"{c} < 8.0 OR {c} > 32.0", None) for c in ("pickup_lat", "dropoff_lat")],
    *[(_N["between"], c, f"{c} < 68.0 OR {c} > 92.0", None) for c in ("pickup_lon", "dropoff_lon")],
    (_N["between"], "fare_cents", "fare_cents < 0", None),
    (_N["between"], "surge_multiplier", "surge_multiplier < 1.0 OR surge_multiplier > 3.0", None),
    (_N["in_set"], "payload_version", "payload_version NOT IN (1, 2)", None),
    (_N["columns"], None, None, "count(*) >= 0|max('" + "[" + ",".join(f'"{c}"' for c in sorted(LANDED_EVENT_COLUMNS)) + "]')"),
]


@query("landed_events_quality", _suite_sql("ride_events", LANDED_CHECKS, "raw_rides_events"), ("ride_events",))
def landed_events_quality(t: DriverTables) -> DataFrame:
    return quality.run_suite(
        _landed(t), "raw_rides_events", quality.landed_events_suite(), F.lit("run-1"), ts_lit(INGESTED)
    )


FACT_CHECKS = [
    (_N["unique"], "ride_id", "ride_id IN (SELECT ride_id FROM enriched GROUP BY 1 HAVING count(*) > 1)", None),
    *[(_N["not_null"], c, f"{c} IS NULL", None) for c in ("ride_id", "terminal_state", "requested_at")],
    (_N["in_set"], "terminal_state", "terminal_state NOT IN ('completed', 'cancelled', 'abandoned')", None),
    (_N["row_count"], None, None, "count(*) BETWEEN (SELECT f FROM bounds) AND (SELECT c FROM bounds)|CAST(count(*) AS VARCHAR)"),
    (_N["max_between"], "ingested_at", None, f"""count(*) > 0|max('"{INGESTED}"')"""),
]
BOUNDS = {
    "counts": "SELECT date_trunc('day', ts) AS run_at, sum(count(*)) OVER (ORDER BY date_trunc('day', ts)) AS observed FROM ev GROUP BY 1",
    "recent": "SELECT * FROM counts ORDER BY run_at DESC LIMIT 10",
    "bounds": """SELECT CAST(coalesce(max(observed), 0) AS BIGINT) AS f,
  CAST(greatest(4 * floor(median(observed)) + 1000, max(observed) + 1000) AS BIGINT) AS c FROM recent""",
}


def _count_results(t: DriverTables) -> DataFrame:
    """A row-count history: the event count at the end of each day."""
    from pyspark.sql import Window

    daily = t.events.groupBy(F.date_trunc("DAY", "ts").alias("run_at")).agg(
        F.count(F.lit(1)).alias("n")
    )
    so_far = F.sum("n").over(Window.orderBy("run_at"))
    return daily.select(
        "run_at",
        F.lit("fct_rides").alias("suite"),
        F.lit(_N["row_count"]).alias("expectation"),
        so_far.cast("string").alias("observed"),
    )


@query("row_count_history", "SELECT run_at, CAST(observed AS BIGINT) AS observed FROM recent", ("ev",), BOUNDS)
def row_count_history(t: DriverTables) -> DataFrame:
    return quality.row_count_history(_count_results(t), "fct_rides")


@query("row_count_bounds", "SELECT f AS floor, c AS ceiling FROM bounds", ("ev",), BOUNDS)
def row_count_bounds(t: DriverTables) -> DataFrame:
    return quality.row_count_bounds(quality.row_count_history(_count_results(t), "fct_rides"))


@query(
    "ride_fact_quality",
    _suite_sql("enriched", FACT_CHECKS, "fct_rides"),
    FACT_USES + ("ev",),
    {**FACT, **BOUNDS},
)
def ride_fact_quality(t: DriverTables) -> DataFrame:
    bounds = quality.row_count_bounds(quality.row_count_history(_count_results(t), "fct_rides"))
    suite = quality.ride_fact_suite(
        bounds.select("floor").scalar(),
        bounds.select("ceiling").scalar(),
        ts_lit(INGESTED) - F.make_dt_interval(mins=F.lit(30)),
    )
    return quality.run_suite(_fact(t), "fct_rides", suite, F.lit("run-1"), ts_lit(INGESTED))


@query(
    "quality_summary",
    f"""SELECT run_id, suite, count(*) FILTER (success) AS passed, count(*) FILTER (NOT success) AS failed,
  count(*) FILTER (success) / count(*)::DOUBLE AS pass_rate FROM ({_suite_sql("ride_events", LANDED_CHECKS, "raw_rides_events")}) GROUP BY 1, 2""",
    ("ride_events",),
)
def quality_summary(t: DriverTables) -> DataFrame:
    return quality.suite_summary(landed_events_quality(t))


@query(
    "column_tests",
    _suite_sql(
        "orders",
        [
            (_N["unique"], "o_custkey", "o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)", None),
            (_N["not_null"], "o_orderdate", "o_orderdate IS NULL", None),
            (_N["unique"], "o_orderkey", "o_orderkey IN (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)", None),
            (_N["in_set"], "o_orderstatus", "o_orderstatus NOT IN ('F', 'O')", None),
        ],
        "orders",
    ),
)
def column_tests(t: DriverTables) -> DataFrame:
    tests = [
        quality.Expectation("unique", "o_custkey"),
        quality.Expectation("not_null", "o_orderdate"),
        quality.Expectation("unique", "o_orderkey"),
        quality.Expectation("in_set", "o_orderstatus", ("F", "O")),
    ]
    return quality.run_suite(t.table("orders"), "orders", tests, F.lit("run-1"), ts_lit(INGESTED))


def _contract_checks(model: str) -> list[tuple]:
    """A contract as (expectation, column, violation, None) rows for the SQL."""
    contract = contracts.CONTRACTS[model]
    rows = [(_N["unique"], c, f"{c} IN (SELECT {c} FROM t GROUP BY 1 HAVING count(*) > 1)", None) for c in contract.unique]
    rows += [(_N["not_null"], c, f"{c} IS NULL", None) for c in (*contract.unique, *contract.not_null)]
    for c, values in contract.accepted.items():
        rows.append((_N["in_set"], c, f"{c} NOT IN ({', '.join(map(repr, values))})", None))
    rows += [("relationships", c, f"{c} NOT IN (SELECT city_id FROM cities WHERE city_id <> 3)", None) for c in contract.refers]
    return rows


@query(
    "event_contract",
    _suite_sql("t", _contract_checks("stg_rides__events"), "stg_rides__events"),
    ("ride_events", "cities"),
    {"t": f"""SELECT *, event_ts AS event_at, CASE WHEN k % 10 <> 0 THEN kafka_offset END AS event_seq,
  TIMESTAMP '{INGESTED}' AS ingested_at FROM ride_events"""},
)
def event_contract(t: DriverTables) -> DataFrame:
    """The staging contract on events with a hole in one column, against a seed without city 3."""
    seq = F.when(F.col("k") % 10 != 0, F.col("kafka_offset"))
    staged = marts.stage_events(t.ride_events.withColumns({"event_seq": seq, "ingested_at": ts_lit(INGESTED)}))
    parents = {"dim_cities": marts.dim_cities(t.cities).where("city_id <> 3")}
    return contracts.check_model(
        staged, "stg_rides__events", parents, F.lit("run-1"), ts_lit(INGESTED), "warn"
    )


@query(
    "ride_fact_contract",
    _suite_sql("t", _contract_checks("fct_rides"), "fct_rides"),
    (*FACT_USES, "cities"),
    {**FACT, "t": f"SELECT *, TIMESTAMP '{INGESTED}' AS ingested_at FROM enriched"},
)
def ride_fact_contract(t: DriverTables) -> DataFrame:
    parents = {"dim_cities": marts.dim_cities(t.cities).where("city_id <> 3")}
    return contracts.check_model(
        _fact(t), "fct_rides", parents, F.lit("run-1"), ts_lit(INGESTED), "warn"
    )


@query("city_list", f"SELECT city_id, name AS city_name, center_lat, center_lon FROM ({SEED_SQL})")
def city_list(t: DriverTables) -> DataFrame:
    return dashboards.city_list(marts.dim_cities(seeded_cities(t)))


@query(
    "rides_without_duration",
    """SELECT ride_id, terminal_state, started_at, ride_duration_sec FROM enriched WHERE terminal_state = 'completed'
  AND started_at IS NOT NULL AND (ride_duration_sec IS NULL OR ride_duration_sec <= 0)""",
    FACT_USES,
    FACT,
)
def rides_without_duration(t: DriverTables) -> DataFrame:
    return quality.completed_without_duration(_fact(t))


@query(
    "far_future_events",
    "SELECT event_id, event_ts AS event_at FROM ride_events WHERE event_ts > TIMESTAMP '2024-01-10' + INTERVAL 14 DAY",
    ("ride_events",),
)
def far_future_events(t: DriverTables) -> DataFrame:
    return quality.far_future_events(marts.stage_events(t.ride_events), ts_lit("2024-01-10"))


@query(
    "negative_fares",
    "SELECT ride_id, fare_cents - 2000 AS fare_cents FROM enriched WHERE fare_cents - 2000 < 0",
    FACT_USES,
    FACT,
)
def negative_fares(t: DriverTables) -> DataFrame:
    return quality.negative_fares(_fact(t).withColumn("fare_cents", F.col("fare_cents") - 2000))


@query(
    "payment_fare_mismatch",
    """SELECT ride_id, fare_cents, paid_amount_cents, payment_status FROM enriched WHERE terminal_state = 'completed'
  AND payment_status = 'completed' AND paid_amount_cents IS DISTINCT FROM fare_cents""",
    FACT_USES,
    FACT,
)
def payment_fare_mismatch(t: DriverTables) -> DataFrame:
    return quality.payment_fare_mismatch(_fact(t))


DQ_SQL = """SELECT event_type AS suite, strftime(ts, '%Y-%m-%d') AS run_id, date_trunc('day', ts) AS run_at, 'check_' || (k % 5) AS expectation,
  CASE WHEN k % 2 = 0 THEN 'col_' || (k % 3) END AS column_name, min(k) % 4 <> 0 AS success, max(CASE WHEN k % 9 = 0 THEN 'fail' ELSE 'warn' END) AS mode
  FROM ev GROUP BY ALL"""


def _dq_results(t: DriverTables) -> DataFrame:
    k = F.col("k")
    return t.events.groupBy(
        F.col("event_type").alias("suite"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.date_trunc("DAY", "ts").alias("run_at"),
        F.concat(F.lit("check_"), k % 5).alias("expectation"),
        F.when(k % 2 == 0, F.concat(F.lit("col_"), k % 3)).alias("column_name"),
    ).agg(
        (F.min("k") % 4 != 0).alias("success"),
        F.max(F.when(k % 9 == 0, "fail").otherwise("warn")).alias("mode"),
    )


@query(
    "latest_quality_runs",
    """SELECT suite, run_at, max(mode) AS mode, count(*) AS n_expectations, count(*) FILTER (success) AS n_pass,
  list_aggregate(list_sort(array_agg(expectation || coalesce(' [' || column_name || ']', '')) FILTER (NOT success)), 'string_agg', ', ') AS failed
  FROM dq WHERE run_id = (SELECT max(run_id) FROM dq d WHERE d.suite = dq.suite) GROUP BY 1, 2""",
    ("ev",),
    {"dq": DQ_SQL},
)
def latest_quality_runs(t: DriverTables) -> DataFrame:
    rows = dashboards.latest_quality(_dq_results(t))
    return rows.withColumn("failed", F.array_join("failed", ", "))


@query(
    "landed_id_audit",
    """SELECT (SELECT count(DISTINCT event_id) FROM ride_events WHERE k % 17 <> 5 AND event_id NOT IN (SELECT event_id FROM ride_events WHERE k % 13 > 3)) AS n_missing,
  (SELECT count(DISTINCT event_id) FROM ride_events WHERE k % 13 > 3 AND event_id NOT IN (SELECT event_id FROM ride_events WHERE k % 17 <> 5)) AS n_unexpected,
  count(*) AS n_rows, count(DISTINCT event_id) AS n_distinct FROM ride_events WHERE k % 13 > 3""",
    ("ride_events",),
)
def landed_id_audit(t: DriverTables) -> DataFrame:
    """Some ids were sent and did not land, and some landed that the sender does not know."""
    landed = poison.clean_rows(poison.decode_ride_events(t.wire))
    return ops.ledger_audit(t.ride_events.where("k % 17 <> 5"), landed, "event_id")


# --- operations ----------------------------------------------------------------------------------


@query(
    "consumer_lag",
    """SELECT 'sink' AS consumer_group, 'rides.events' AS topic, p AS partition, greatest(e - c, 0) AS lag FROM
  (SELECT kafka_partition AS p, max(kafka_offset) AS e, max(kafka_offset) FILTER (k % 7 = 0) + 1 AS c FROM ride_events WHERE kafka_partition <> 2 GROUP BY 1)""",
    ("ride_events",),
)
def consumer_lag(t: DriverTables) -> DataFrame:
    """Lag behind the highest offset; partition 2 was never committed and stays out."""
    rows = t.ride_events.select(
        F.lit("rides.events").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        "k",
    )
    ends = rows.groupBy("topic", "partition").agg(F.max("offset").alias("end_offset"))
    ledger = offsets.batch_offsets(rows.where("k % 7 = 0 AND partition <> 2"), "sink")
    return ops.consumer_lag(ends, ops.resume_offsets(ledger))


LAG_SAMPLES = """SELECT kafka_partition AS p, event_id, ts, k * 20 > 1000 AS breach FROM ev"""
RUN_SQL = """SELECT * EXCLUDE (n), {extra} FROM (SELECT p, n, min(ts) AS started_at, max(ts) AS last_at, count(*) AS n_samples,
  max(ts) >= min(ts) + INTERVAL 2 MINUTE AS firing FROM (SELECT *, sum(opens) OVER (PARTITION BY p ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n
  FROM (SELECT *, CASE WHEN lag(breach) OVER w IS DISTINCT FROM breach OR ts - lag(ts) OVER w > INTERVAL 5 MINUTE THEN 1 ELSE 0 END AS opens FROM samples
   WINDOW w AS (PARTITION BY p ORDER BY ts, event_id))) WHERE breach GROUP BY p, n)"""


@query(
    "lag_alerts",
    RUN_SQL.format(extra="'sink' AS consumer_group, 'rides.events' AS topic").replace("SELECT * EXCLUDE (n)", "SELECT * EXCLUDE (n) RENAME (p AS partition)"),
    ("ev",),
    {"samples": LAG_SAMPLES},
)
def lag_alerts(t: DriverTables) -> DataFrame:
    samples = t.events.select(
        F.lit("sink").alias("consumer_group"),
        F.lit("rides.events").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        "ts",
        (F.col("k") * 20).alias("lag"),
        "event_id",
    )
    return ops.lag_alerts(samples, order=("ts", "event_id"))


@query(
    "target_down_alerts",
    RUN_SQL.format(extra="1 AS _x").replace("SELECT * EXCLUDE (n), 1 AS _x", "SELECT * EXCLUDE (n) RENAME (p AS job)"),
    ("ev",),
    {
        "samples": """SELECT event_type AS p, date_trunc('minute', ts) AS ts, 0 AS event_id,
  max(CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END) = 0 AS breach FROM ev GROUP BY ALL"""
    },
)
def target_down_alerts(t: DriverTables) -> DataFrame:
    samples = t.events.select(
        F.col("event_type").alias("job"),
        F.date_trunc("MINUTE", "ts").alias("ts"),
        (F.col("k") % 3 == 0).cast("int").alias("up"),
    )
    return ops.down_alerts(samples)


@query(
    "counter_rates",
    """SELECT service, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, CAST(sum(CASE WHEN b IS NULL THEN 0 WHEN k >= b THEN k - b ELSE k END) AS DOUBLE) / 300 AS per_second
  FROM (SELECT event_type AS service, ts, k, lag(k) OVER (PARTITION BY event_type ORDER BY ts) AS b FROM (SELECT event_type, ts, max(k) AS k FROM ev GROUP BY ALL)) GROUP BY 1, 2""",
    ("ev",),
)
def counter_rates(t: DriverTables) -> DataFrame:
    samples = t.events.groupBy(F.col("event_type").alias("service"), "ts").agg(F.max("k").alias("total"))
    return ops.counter_rates(samples, ["service"], "ts", "total", 300)


LE = (1.0, 5.0, 10.0, 20.0, 50.0)


@query(
    "bucket_p95_latency",
    """SELECT service, round(max(CASE WHEN cum >= 0.95 * total AND before < 0.95 * total THEN CASE WHEN isinf(le) THEN low ELSE
  low + (le - low) * (0.95 * total - before) / (cum - before) END END), 6) AS p95 FROM (SELECT *, lag(le, 1, 0.0::DOUBLE) OVER w AS low, lag(cum, 1, 0) OVER w AS before,
   max(cum) OVER (PARTITION BY service) AS total FROM (SELECT event_type AS service, le, count(*) FILTER (value <= le) AS cum FROM ev,
    (SELECT unnest([1.0::DOUBLE, 5.0, 10.0, 20.0, 50.0, 'inf'::DOUBLE]) AS le) GROUP BY 1, 2) WINDOW w AS (PARTITION BY service ORDER BY le)) GROUP BY 1""",
    ("ev",),
)
def bucket_p95_latency(t: DriverTables) -> DataFrame:
    edges = [F.lit(e) for e in (*LE, float("inf"))]
    counted = t.events.groupBy(F.col("event_type").alias("service")).agg(
        *[F.count_if(F.col("value") <= e).alias(f"c{i}") for i, e in enumerate(edges)]
    )
    buckets = counted.select(
        "service",
        F.inline(
            F.array(
                *[F.struct(e.alias("le"), F.col(f"c{i}").alias("cum")) for i, e in enumerate(edges)]
            )
        ),
    )
    return rounded(quantiles.bucket_quantile(buckets, ["service"], "le", "cum", 0.95, "p95"), "p95")


@query(
    "lifecycle_violations",
    """SELECT ride_id, kafka_offset, event_type, p AS prev_type, v AS violation FROM (SELECT *, CASE WHEN p IS NULL THEN CASE WHEN event_type <> 'requested'
  THEN 'first is not requested' WHEN event_ts < pt THEN 'time runs back' END WHEN p IN ('completed', 'cancelled') THEN 'after terminal'
  WHEN (p || '>' || event_type) NOT IN ('requested>matched','requested>cancelled','matched>driver_arrived','matched>cancelled',
   'driver_arrived>started','driver_arrived>cancelled','started>completed','started>cancelled') THEN 'illegal edge'
  WHEN event_ts < pt THEN 'time runs back' END AS v FROM (SELECT *, lag(event_type) OVER w AS p, lag(event_ts) OVER w AS pt FROM ride_events
   WINDOW w AS (PARTITION BY ride_id ORDER BY kafka_offset))) WHERE v IS NOT NULL""",
    ("ride_events",),
)
def lifecycle_violations(t: DriverTables) -> DataFrame:
    assert len(EVENT_ORDINALS) == 6
    return ops.lifecycle_violations(t.ride_events)


@query(
    "imperfection_profile",
    """SELECT kafka_partition, count(*) AS n_events, count(*) FILTER (b > 0 AND b <= 30000000) AS n_out_of_order, count(*) FILTER (b > 30000000) AS n_late,
  count(*) FILTER (k % 13 = 0) AS n_malformed, count(*) FILTER (event_type = 'requested' AND dropoff_lat IS NULL) AS n_null_dropoff,
  count(*) - count(DISTINCT event_id) AS n_duplicate FROM (SELECT *, epoch_us(max(event_ts) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) - epoch_us(event_ts) AS b FROM ride_events) GROUP BY 1""",
    ("ride_events",),
)
def imperfection_profile(t: DriverTables) -> DataFrame:
    return ops.imperfection_profile(t.ride_events, F.col("k") % 13 == 0)


@query(
    "throughput",
    """SELECT kafka_partition, count(*) AS n_rows, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS span_sec,
  count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE) AS rows_per_sec FROM ev GROUP BY 1""",
    ("ev",),
)
def throughput(t: DriverTables) -> DataFrame:
    return ops.throughput(t.events, "ts", ["kafka_partition"])


@query(
    "latency_summary",
    """SELECT round(median(value), 6) AS p50_sec, round(max(v) FILTER (rn = greatest(CAST(floor(0.95::DOUBLE * n) AS BIGINT) - 1, 0)), 6) AS p95_sec,
  count(*) AS n_values FROM (SELECT value, value AS v, row_number() OVER (ORDER BY value) - 1 AS rn, count(*) OVER () AS n FROM ev)""",
    ("ev",),
)
def latency_summary(t: DriverTables) -> DataFrame:
    return rounded(ops.latency_summary(t.events, "value"), "p50_sec", "p95_sec")
