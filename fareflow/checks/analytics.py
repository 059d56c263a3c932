"""Aggregations, windows, joins and marts over the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.checks.registry import query
from fareflow.checks.sessions import rounded
from fareflow.operators import joins, late, quantiles, shifts, slices, windows
from fareflow.operators.latest import latest_per_key
from fareflow.operators.sessions import build_sessions, with_session_ts
from fareflow.plans import dashboards, marts
from fareflow.sources.derived import CTES, DriverTables

INGESTED = "2024-02-01 00:00:00"

MARKED = ", ".join(f"CAST(event_type = '{x}' AS INTEGER) AS {x}" for x in ("requested", "completed", "cancelled"))
STATES = ", ".join(f"CAST(terminal_state = '{x}' AS INTEGER) AS {x}" for x in ("completed", "cancelled", "abandoned"))
# The value at share q of a sorted list v, between its neighbours.
AT_SHARE = """v[CAST(floor((len(v) - 1) * {q}) AS BIGINT) + 1] + ((len(v) - 1) * {q} - floor((len(v) - 1) * {q}))
    * (v[CAST(ceil((len(v) - 1) * {q}) AS BIGINT) + 1] - v[CAST(floor((len(v) - 1) * {q}) AS BIGINT) + 1])"""
EXTRA = {
    "session_times": "SELECT *, coalesce(ended_ts, requested_ts) AS session_ts FROM sessions",
    # Counts and rates as sums of 0/1 columns, one row an event.
    "marked": f"SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS m, city_id, surge_multiplier, {MARKED} FROM ride_events",
    "metrics": """SELECT m AS window_start, m + INTERVAL 1 MINUTE AS window_end, city_id, CAST(sum(requested) AS BIGINT) AS requests,
  CAST(sum(completed) AS BIGINT) AS completes, CAST(sum(cancelled) AS BIGINT) AS cancels,
  CASE WHEN sum(completed + cancelled) > 0 THEN sum(completed)::DOUBLE / sum(completed + cancelled)::DOUBLE END AS completion_rate,
  CASE WHEN sum(completed + cancelled) > 0 THEN sum(cancelled)::DOUBLE / sum(completed + cancelled)::DOUBLE END AS cancellation_rate,
  CASE WHEN sum(requested) > 0 THEN sum(requested * surge_multiplier) / sum(requested)::DOUBLE END AS mean_surge
  FROM marked GROUP BY m, city_id""",
    # A session lies in bucket b if its time to match reaches 5 b seconds and, below the last bucket, not 5 b + 5.
    "bucketed": """SELECT time_bucket(INTERVAL 1 MINUTE, session_ts) AS window_start, session_ts, city_id, CAST(b AS INTEGER) AS bucket
  FROM session_times, range(61) AS buckets(b) WHERE time_to_match_sec >= 5 * b AND (time_to_match_sec < 5 * b + 5 OR b = 60)""",
    "hist": """SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, city_id, bucket, count(*) AS cnt
  FROM bucketed GROUP BY window_start, city_id, bucket""",
    "day_hist": """SELECT time_bucket(INTERVAL 1 DAY, session_ts) AS window_start, city_id, bucket, count(*) AS cnt
  FROM bucketed GROUP BY 1, city_id, bucket""",
    # The bucket of the ride at rank ceil(q n) of each window's sorted rides; its upper edge is the quantile.
    "window_quantiles": """SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, city_id,
  (v[CAST(ceil(len(v) * 0.5::DOUBLE) AS BIGINT)] + 1) * 5.0::DOUBLE AS p50_time_to_match_sec,
  (v[CAST(ceil(len(v) * 0.95::DOUBLE) AS BIGINT)] + 1) * 5.0::DOUBLE AS p95_time_to_match_sec, CAST(len(v) AS BIGINT) AS matched_rides
  FROM (SELECT window_start, city_id, list_sort(list(bucket)) AS v FROM bucketed GROUP BY window_start, city_id)""",
    "metrics_full": """SELECT m.*, q.p50_time_to_match_sec, q.p95_time_to_match_sec FROM metrics m
  LEFT JOIN window_quantiles q ON q.window_start = m.window_start AND q.city_id = m.city_id""",
    "enriched": """SELECT s.* RENAME (requested_ts AS requested_at, matched_ts AS matched_at, driver_arrived_ts AS driver_arrived_at,
  started_ts AS started_at, ended_ts AS ended_at), c.name AS city_name, p.txn_id, p.amount_cents AS paid_amount_cents,
  p.status AS payment_status, p.method AS payment_method, p.payment_ts AS paid_at, p.txn_id IS NOT NULL AS is_paid
  FROM sessions s LEFT JOIN payments p ON s.ride_id = p.ride_id LEFT JOIN cities c ON s.city_id = c.city_id""",
    "closed": f"""SELECT city_id, city_name, time_bucket(INTERVAL 1 HOUR, requested_at) AS hour_start, {STATES}, surge_multiplier, time_to_match_sec,
  CASE WHEN terminal_state = 'completed' THEN fare_cents END AS fare, CASE WHEN payment_status = 'completed' THEN paid_amount_cents END AS paid,
  CAST(coalesce(is_late_arrival, false) AS INTEGER) AS late FROM enriched""",
    "hourly": f"""SELECT city_id, city_name, hour_start, n AS rides_closed, done AS rides_completed, gone AS rides_cancelled, left_ AS rides_abandoned,
  done::DOUBLE / n::DOUBLE AS completion_rate, avg_surge, round({AT_SHARE.format(q='0.5::DOUBLE')}, 6) AS p50_time_to_match_sec,
  round({AT_SHARE.format(q='0.95::DOUBLE')}, 6) AS p95_time_to_match_sec, gross_fares_cents, collected_cents, late_arrivals
  FROM (SELECT city_id, city_name, hour_start, count(*) AS n, CAST(sum(completed) AS BIGINT) AS done, CAST(sum(cancelled) AS BIGINT) AS gone,
    CAST(sum(abandoned) AS BIGINT) AS left_, sum(surge_multiplier) / count(*) AS avg_surge, CAST(sum(fare) AS BIGINT) AS gross_fares_cents,
    CAST(sum(paid) AS BIGINT) AS collected_cents, CAST(sum(late) AS BIGINT) AS late_arrivals,
    list_sort(list(time_to_match_sec) FILTER (time_to_match_sec IS NOT NULL)) AS v FROM closed GROUP BY city_id, city_name, hour_start)""",
    "lagged": """SELECT *, lag(ts) OVER w AS prev_at, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon, lag(status) OVER w AS prev_status
  FROM pings WINDOW w AS (PARTITION BY driver_id ORDER BY ts, ping_id)""",
    # The pings that open a shift; a ping's shift is the number of them up to it.
    "breaks": """SELECT driver_id, ping_id, ts FROM lagged WHERE prev_at IS NULL
  UNION SELECT driver_id, ping_id, ts FROM lagged WHERE date_diff('microsecond', prev_at, ts) > 30 * 60 * 1000000
  UNION SELECT driver_id, ping_id, ts FROM lagged WHERE prev_status = 'offline'""",
    # Great-circle distance from the angle between two unit vectors: length of their cross product against their dot product.
    "stepped": """SELECT ping_id, 6371.0088::DOUBLE * atan2(sqrt(power(cos(radians(lat)) * sin(radians(lon - prev_lon)), 2)
   + power(cos(radians(prev_lat)) * sin(radians(lat)) - sin(radians(prev_lat)) * cos(radians(lat)) * cos(radians(lon - prev_lon)), 2)),
   sin(radians(prev_lat)) * sin(radians(lat)) + cos(radians(prev_lat)) * cos(radians(lat)) * cos(radians(lon - prev_lon))) AS km FROM lagged""",
    "numbered": """SELECT p.*, CAST(count(b.ping_id) AS BIGINT) AS shift_seq, CAST(coalesce(bool_or(b.ping_id = p.ping_id), false) AS INTEGER) AS is_new,
  coalesce(any_value(s.km), 0) AS step_km FROM pings p JOIN breaks b ON b.driver_id = p.driver_id AND (b.ts < p.ts OR (b.ts = p.ts AND b.ping_id <= p.ping_id))
  JOIN stepped s ON s.ping_id = p.ping_id GROUP BY ALL""",
    "shifts": """SELECT driver_id || '.' || shift_seq AS shift_id, driver_id, min(city_id) AS city_id, min(ts) AS shift_started_at, max(ts) AS shift_ended_at,
  date_diff('microsecond', min(ts), max(ts)) / 1000000.0::DOUBLE / 60.0::DOUBLE AS active_minutes,
  coalesce(sum(step_km) FILTER (is_new = 0), 0) AS distance_km, count(*) AS ping_count, sum(speed_kmh) / count(speed_kmh) AS avg_speed_kmh,
  sum(CAST(status = 'on_trip' AS INTEGER))::DOUBLE / count(*)::DOUBLE AS on_trip_share FROM numbered GROUP BY driver_id, shift_seq""",
}
METRICS = {n: EXTRA[n] for n in ("session_times", "marked", "metrics", "bucketed", "hist", "window_quantiles", "metrics_full")}
FACT = {n: EXTRA[n] for n in ("enriched", "closed", "hourly")}
SHIFTS = {n: EXTRA[n] for n in ("lagged", "breaks", "stepped", "numbered", "shifts")}
ALL = {**METRICS, **FACT, **SHIFTS}
RIDE_USES = ("ride_events", "sessions")
FACT_USES = ("sessions", "payments", "cities")


def _ingested():
    return F.lit(INGESTED).cast("timestamp")


def _sessions(t: DriverTables) -> DataFrame:
    return with_session_ts(t.sessions)


def _fact(t: DriverTables) -> DataFrame:
    staged = marts.stage_sessions(marts.with_ingest_time(t.sessions, _ingested()))
    enriched = marts.enriched_rides(
        staged, marts.stage_payments(t.payments), marts.dim_cities(t.cities)
    )
    return marts.ride_fact(enriched)


def _metrics_full(t: DriverTables) -> DataFrame:
    hist = windows.match_histogram(_sessions(t))
    return windows.city_metrics_full(
        windows.city_metrics(t.ride_events), windows.match_quantiles(hist)
    )


PING_ORDER = ("ts", "ping_id")


# --- aggregations ----------------------------------------------------------------------------


@query("city_minute_metrics", "SELECT * FROM metrics", RIDE_USES, METRICS)
def city_minute_metrics(t: DriverTables) -> DataFrame:
    return windows.city_metrics(t.ride_events)


@query("match_time_histogram", "SELECT * FROM hist", RIDE_USES, METRICS)
def match_time_histogram(t: DriverTables) -> DataFrame:
    return windows.match_histogram(_sessions(t))


@query("match_time_quantiles", "SELECT * FROM window_quantiles", RIDE_USES, METRICS)
def match_time_quantiles(t: DriverTables) -> DataFrame:
    return windows.match_quantiles(windows.match_histogram(_sessions(t)))


@query("city_metrics_view", "SELECT * FROM metrics_full", RIDE_USES, METRICS)
def city_metrics_view(t: DriverTables) -> DataFrame:
    return _metrics_full(t)


@query("city_hourly_rollup", "SELECT * FROM hourly", FACT_USES, FACT)
def city_hourly_rollup(t: DriverTables) -> DataFrame:
    return rounded(
        marts.city_hourly(_fact(t)), "p50_time_to_match_sec", "p95_time_to_match_sec"
    )


@query(
    "completed_rides_per_driver",
    """SELECT o_custkey || '' AS driver_id, count(*) AS completed_rides FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def completed_rides_per_driver(t: DriverTables) -> DataFrame:
    rides = t.table("orders").select(
        F.col("o_custkey").cast("string").alias("driver_id"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("cancelled").alias("terminal_state"),
    )
    return marts.completed_per_driver(rides)


SHIFT_SELECT = "SELECT * EXCLUDE (distance_km), round(distance_km, 6) AS distance_km FROM shifts"


@query("driver_shifts", SHIFT_SELECT, ("pings",), SHIFTS)
def driver_shifts(t: DriverTables) -> DataFrame:
    return rounded(marts.shift_fact(t.pings, PING_ORDER), "distance_km")


@query(
    "lifetime_totals",
    """SELECT count(*) AS rides, CAST(count(*) FILTER (terminal_state = 'completed') AS DOUBLE) / count(*) AS completion_rate,
  avg(surge_multiplier) AS avg_surge, round((SELECT avg(on_trip_share) FROM shifts), 6) AS driver_utilisation,
  (SELECT count(*) FROM shifts) AS shifts FROM enriched""",
    (*FACT_USES, "pings"),
    {**FACT, **SHIFTS},
)
def lifetime_totals(t: DriverTables) -> DataFrame:
    return rounded(
        dashboards.lifetime_totals(_fact(t), shifts.driver_shifts(t.pings, PING_ORDER)),
        "driver_utilisation",
    )


@query(
    "ride_totals",
    """SELECT count(*) AS rides_closed, count(*) FILTER (terminal_state = 'completed') AS rides_completed,
  max(requested_ts) AS max_requested_ts FROM sessions""",
    ("sessions",),
)
def ride_totals(t: DriverTables) -> DataFrame:
    return dashboards.ride_totals(t.sessions)


@query(
    "city_scorecard",
    """SELECT city_name, CAST(sum(rides_closed) AS BIGINT) AS rides_closed, CAST(sum(rides_completed) AS BIGINT) AS rides_completed,
  CAST(sum(rides_cancelled) AS BIGINT) AS rides_cancelled, CAST(sum(rides_abandoned) AS BIGINT) AS rides_abandoned,
  CAST(sum(rides_completed) AS DOUBLE) / CAST(sum(rides_closed) AS DOUBLE) AS completion_rate, round(avg(avg_surge), 6) AS avg_surge,
  CAST(sum(late_arrivals) AS BIGINT) AS late_arrivals FROM hourly GROUP BY 1""",
    FACT_USES,
    FACT,
)
def city_scorecard(t: DriverTables) -> DataFrame:
    return rounded(dashboards.city_scorecard(marts.city_hourly(_fact(t))), "avg_surge")


@query(
    "utilisation_by_city",
    """SELECT coalesce(name, CAST(s.city_id AS VARCHAR)) AS city, count(*) AS shifts, round(avg(on_trip_share), 6) AS on_trip_share,
  round(avg(active_minutes), 6) AS avg_active_minutes, round(avg(distance_km), 6) AS avg_distance_km,
  round(avg(avg_speed_kmh), 6) AS avg_speed_kmh FROM shifts s LEFT JOIN (SELECT * FROM cities WHERE city_id <> 3) c
  ON c.city_id = s.city_id GROUP BY 1""",
    ("pings", "cities"),
    SHIFTS,
)
def utilisation_by_city(t: DriverTables) -> DataFrame:
    named = marts.dim_cities(t.cities).where("city_id <> 3")
    return rounded(
        dashboards.utilisation_by_city(shifts.driver_shifts(t.pings, PING_ORDER), named),
        "on_trip_share", "avg_active_minutes", "avg_distance_km", "avg_speed_kmh",
    )


@query(
    "quarter_hour_rides",
    """SELECT time_bucket(INTERVAL 15 MINUTE, requested_at) AS time, city_name, CAST(count(*) AS DOUBLE) AS rides,
  CAST(count(*) FILTER (terminal_state = 'completed') AS DOUBLE) / count(*) AS completion_rate FROM enriched GROUP BY 1, 2""",
    FACT_USES,
    FACT,
)
def quarter_hour_rides(t: DriverTables) -> DataFrame:
    return dashboards.rides_by_city(_fact(t))


@query(
    "rides_per_minute",
    """SELECT date_trunc('minute', requested_ts) AS minute_ts, city_id, count(*) AS rides FROM sessions
  WHERE requested_ts > (SELECT max(requested_ts) FROM sessions) - INTERVAL 48 HOUR GROUP BY 1, 2""",
    ("sessions",),
)
def rides_per_minute(t: DriverTables) -> DataFrame:
    return dashboards.rides_per_minute(t.sessions, 48)


@query(
    "hour_over_hour",
    """SELECT CASE WHEN requested_ts > m - INTERVAL 1 HOUR THEN 'cur' ELSE 'prev' END AS bucket, count(*) AS rides_closed,
  avg(CASE WHEN terminal_state = 'completed' THEN 1 ELSE 0 END) AS completion_rate
  FROM sessions, (SELECT max(requested_ts) AS m FROM sessions) WHERE requested_ts > m - INTERVAL 2 HOUR GROUP BY 1""",
    ("sessions",),
)
def hour_over_hour(t: DriverTables) -> DataFrame:
    return dashboards.hour_over_hour(t.sessions)


P95_SQL = """SELECT coalesce(w.p, f.p) AS p95_sec, CASE WHEN w.p IS NULL THEN 'ride fact' ELSE '1-minute windows' END AS source
  FROM (SELECT avg(p95_time_to_match_sec) AS p FROM {windows} WHERE window_end > (SELECT max(window_end) FROM {windows}) - INTERVAL 15 MINUTE) w,
  (SELECT round(quantile_cont(time_to_match_sec, 0.95), 6) AS p FROM enriched) f"""


@query("p95_from_windows", P95_SQL.format(windows="window_quantiles"), (*RIDE_USES, *FACT_USES), {**METRICS, **FACT})
def p95_from_windows(t: DriverTables) -> DataFrame:
    quantile_windows = windows.match_quantiles(windows.match_histogram(_sessions(t)))
    return rounded(dashboards.p95_time_to_match(quantile_windows, _fact(t)), "p95_sec")


@query("p95_from_fact", P95_SQL.format(windows="nothing"), (*RIDE_USES, *FACT_USES),
       {**METRICS, **FACT, "nothing": "SELECT * FROM window_quantiles WHERE matched_rides < 0"})
def p95_from_fact(t: DriverTables) -> DataFrame:
    """No window has a value, so the fact answers."""
    empty = windows.match_quantiles(windows.match_histogram(_sessions(t))).where("matched_rides < 0")
    return rounded(dashboards.p95_time_to_match(empty, _fact(t)), "p95_sec")


@query(
    "versions_with_promo",
    "SELECT payload_version, count(*) AS n_events, count(promo_code) AS n_promo FROM ride_events GROUP BY 1",
    ("ride_events",),
)
def versions_with_promo(t: DriverTables) -> DataFrame:
    return dashboards.versions_with_promo(t.ride_events)


@query(
    "exact_price_quantiles",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95,
  count(*) AS n_values FROM lineitem GROUP BY 1""",
)
def exact_price_quantiles(t: DriverTables) -> DataFrame:
    """Exact quantiles of three groups that hold a third of the table each."""
    rows = quantiles.exact_quantiles(
        t.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p95": 0.95}
    )
    return rows.withColumns({"p50": F.round("p50", 4), "p95": F.round("p95", 4)})


@query(
    "distinct_events",
    "SELECT count(DISTINCT event_id) AS n FROM ride_events",
    ("ride_events",),
)
def distinct_events(t: DriverTables) -> DataFrame:
    return t.ride_events.agg(F.count_distinct("event_id").alias("n"))


# --- joins -----------------------------------------------------------------------------------

PAID_SQL = """SELECT s.ride_id, p.txn_id, s.city_id, s.terminal_state, s.ended_ts, s.fare_cents, p.amount_cents, p.status AS payment_status,
  p.method AS payment_method, p.payment_ts, CAST(date_sub('second', s.ended_ts, p.payment_ts) AS DOUBLE) AS payment_delay_sec
  FROM session_times s JOIN payments p ON s.ride_id = p.ride_id AND p.payment_ts BETWEEN s.session_ts AND s.session_ts + INTERVAL 15 MINUTE"""
UNPAID_SQL = """SELECT s.ride_id, s.city_id, s.terminal_state, s.ended_ts, s.fare_cents FROM session_times s LEFT JOIN payments p
  ON s.ride_id = p.ride_id AND p.payment_ts BETWEEN s.session_ts AND s.session_ts + INTERVAL 15 MINUTE
  WHERE s.terminal_state = 'completed' AND p.txn_id IS NULL"""
TIMES = {"session_times": EXTRA["session_times"]}


@query("ride_payment_join", PAID_SQL, ("sessions", "payments"), TIMES)
def ride_payment_join(t: DriverTables) -> DataFrame:
    return joins.ride_payments(_sessions(t), t.payments)


@query("unpaid_rides", UNPAID_SQL, ("sessions", "payments"), TIMES)
def unpaid_rides(t: DriverTables) -> DataFrame:
    return joins.unpaid_rides(_sessions(t), t.payments)


FACT_SELECT = """SELECT ride_id, rider_id, driver_id, city_id, city_name, terminal_state, event_seq, requested_at, matched_at, driver_arrived_at,
  started_at, ended_at, time_to_match_sec, time_to_pickup_sec, ride_duration_sec, round(haversine_distance_km, 6) AS haversine_distance_km,
  round(avg_speed_kmh, 6) AS avg_speed_kmh, is_late_arrival, fare_cents, surge_multiplier, promo_code, txn_id, paid_amount_cents,
  payment_status, payment_method, paid_at, is_paid, TIMESTAMP '""" + INGESTED + "' AS ingested_at FROM enriched"


@query("ride_fact", FACT_SELECT, FACT_USES, FACT)
def ride_fact(t: DriverTables) -> DataFrame:
    return rounded(_fact(t), "haversine_distance_km", "avg_speed_kmh")


@query(
    "customer_order_enrichment",
    """SELECT c_custkey, n_name, o_orderkey, o_orderkey IS NOT NULL AS has_order FROM customer
  LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def customer_order_enrichment(t: DriverTables) -> DataFrame:
    orders = t.table("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    customers = t.table("customer").select("c_custkey", "c_nationkey")
    nations = t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        joins.left_join_unique(customers, orders, "c_custkey")
        .join(nations, "c_nationkey", "left")
        .select("c_custkey", "n_name", "o_orderkey", F.col("o_orderkey").isNotNull().alias("has_order"))
    )


DRIVER_SQL = """SELECT p.driver_id, p.city_id, p.status, p.ts AS last_seen_at, coalesce(c.n, 0) AS completed_rides,
  CASE WHEN coalesce(c.n, 0) >= 30 THEN 'gold' WHEN coalesce(c.n, 0) >= 10 THEN 'silver' ELSE 'bronze' END AS tier
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY ts DESC, ping_id DESC) AS rn FROM pings) WHERE rn = 1) p
  LEFT JOIN (SELECT driver_id, count(*) AS n FROM sessions WHERE terminal_state = 'completed' GROUP BY 1) c ON p.driver_id = c.driver_id"""


@query("current_drivers", DRIVER_SQL, ("pings", "sessions"))
def current_drivers(t: DriverTables) -> DataFrame:
    pings = marts.stage_locations(t.pings)
    return marts.current_drivers(pings, t.sessions, ("pinged_at", "ping_id"))


@query(
    "orphan_lineitems",
    """SELECT l_suppkey + 50 AS key, count(*) AS n_rows FROM lineitem WHERE l_suppkey + 50 NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1""",
)
def orphan_lineitems(t: DriverTables) -> DataFrame:
    """Shifted supplier keys, so that the check has something to find."""
    lines = t.table("lineitem").select((F.col("l_suppkey") + 50).alias("key"))
    return joins.orphans(lines, t.table("supplier"), "key", "s_suppkey")


# --- window functions ------------------------------------------------------------------------


@query(
    "latest_positions",
    """SELECT driver_id, ts, lat, lon, speed_kmh, status, city_id FROM (SELECT *, row_number() OVER
  (PARTITION BY driver_id ORDER BY ts DESC, ping_id DESC) AS rn FROM pings) WHERE rn = 1""",
    ("pings",),
)
def latest_positions(t: DriverTables) -> DataFrame:
    return dashboards.latest_positions(t.pings, PING_ORDER)


@query(
    "latest_order_per_customer",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER
  (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_order_per_customer(t: DriverTables) -> DataFrame:
    orders = t.table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_per_key(orders, ["o_custkey"], "o_orderdate", "o_orderkey")


@query(
    "previous_ping",
    "SELECT ping_id, prev_at, prev_lat, prev_lon, prev_status FROM lagged",
    ("pings",),
    SHIFTS,
)
def previous_ping(t: DriverTables) -> DataFrame:
    rows = slices.with_previous_row(
        t.pings,
        ["driver_id"],
        PING_ORDER,
        F.floor(F.unix_seconds("ts") / 3600).cast("long"),
        ["ts", "lat", "lon", "status"],
    )
    return rows.select(
        "ping_id",
        F.col("prev.ts").alias("prev_at"),
        F.col("prev.lat").alias("prev_lat"),
        F.col("prev.lon").alias("prev_lon"),
        F.col("prev.status").alias("prev_status"),
    )


@query(
    "numbered_shifts",
    "SELECT ping_id, CAST(shift_seq AS BIGINT) AS shift_seq, is_new, round(step_km, 6) AS step_km FROM numbered",
    ("pings",),
    SHIFTS,
)
def numbered_shifts(t: DriverTables) -> DataFrame:
    rows = shifts.numbered_shifts(t.pings, PING_ORDER)
    return rounded(rows.select("ping_id", "shift_seq", "is_new", "step_km"), "step_km")


@query(
    "cumulative_histogram",
    """SELECT window_start, city_id, bucket, CAST(sum(cnt) OVER (PARTITION BY window_start, city_id ORDER BY bucket) AS BIGINT) AS cum_cnt,
  CAST(sum(cnt) OVER (PARTITION BY window_start, city_id) AS BIGINT) AS total_cnt FROM day_hist""",
    RIDE_USES,
    {**TIMES, "bucketed": EXTRA["bucketed"], "day_hist": EXTRA["day_hist"]},
)
def cumulative_histogram(t: DriverTables) -> DataFrame:
    from pyspark.sql import Window

    hist = windows.match_histogram(_sessions(t), "1 day")
    per_window = Window.partitionBy("window_start", "city_id")
    return hist.select(
        "window_start",
        "city_id",
        "bucket",
        F.sum("cnt").over(per_window.orderBy("bucket")).alias("cum_cnt"),
        F.sum("cnt").over(per_window).alias("total_cnt"),
    )


@query(
    "running_spend",
    """SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_orderstatus
  ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cents_so_far FROM orders""",
)
def running_spend(t: DriverTables) -> DataFrame:
    """A running sum over three keys that hold a third of the rows each."""
    orders = t.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    return slices.with_running(
        orders,
        ["o_orderstatus"],
        ["o_orderdate", "o_orderkey"],
        F.floor(F.unix_seconds("o_orderdate") / 86400).cast("long"),
        F.round(F.col("o_totalprice") * 100).cast("long"),
        "cents_so_far",
        "sum",
    ).select("o_orderkey", "cents_so_far")


SESSION_SQL = """SELECT driver_id, min(ts) AS session_start, max(ts) + INTERVAL 5 MINUTE AS session_end, min(city_id) AS city_id,
  count(*) AS ping_count, CAST(date_sub('second', min(ts), max(ts)) AS DOUBLE) / 60.0::DOUBLE AS active_minutes,
  avg(speed_kmh) * (CAST(date_sub('second', min(ts), max(ts)) AS DOUBLE) / 3600.0::DOUBLE) AS distance_km FROM
  (SELECT *, sum(CASE WHEN prev_at IS NULL OR ts - prev_at > INTERVAL 5 MINUTE THEN 1 ELSE 0 END) OVER
   (PARTITION BY driver_id ORDER BY ts, ping_id ROWS UNBOUNDED PRECEDING) AS n FROM lagged) GROUP BY driver_id, n"""


@query("ping_sessions", SESSION_SQL, ("pings",), SHIFTS)
def ping_sessions(t: DriverTables) -> DataFrame:
    return shifts.ping_sessions(t.pings, PING_ORDER)


LATE_SQL = """SELECT event_id, ride_id, event_type, event_ts, city_id, date_sub('second', event_ts, wm) AS late_by_sec FROM
  (SELECT *, max(event_ts) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
   - INTERVAL 30 SECOND AS wm FROM ride_events) WHERE event_ts < wm"""


@query("late_events", LATE_SQL, ("ride_events",))
def late_events(t: DriverTables) -> DataFrame:
    return late.late_events(t.ride_events)


AS_OF_SQL = (
    "WITH "
    + ", ".join(
        f"{n} AS ({CTES[n]})" for n in ("ev", "ride_typed")
    )
    + f", all_events AS ({CTES['ride_events']})"
    + """, ride_events AS (SELECT * EXCLUDE (closed_at) FROM (SELECT *, min(kafka_offset) FILTER (event_type IN ('completed', 'cancelled'))
   OVER (PARTITION BY ride_id) AS closed_at FROM all_events) WHERE closed_at IS NULL OR kafka_offset <= closed_at), """
    + ", ".join(f"{n} AS ({CTES[n]})" for n in ("slots", "folded", "timed", "sessions"))
    + " SELECT ride_id, terminal_state, event_seq, requested_ts, ended_ts, fare_cents FROM sessions"
)


@query("session_fold_as_of_arrival", AS_OF_SQL)
def session_fold_as_of_arrival(t: DriverTables) -> DataFrame:
    rows = build_sessions(t.ride_events, as_of_arrival=True)
    return rows.select("ride_id", "terminal_state", "event_seq", "requested_ts", "ended_ts", "fare_cents")
