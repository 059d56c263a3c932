from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fareflow.operators import joins, late, offsets, ops, quality, scd2, upsert
from fareflow.plans import dashboards, marts
from fareflow.schemas import DQ_RESULT
from fareflow.sources import seeds
from fareflow.sources.buckets import BucketedTable
from tests.rides import T0, collect, event, events_df, full_ride


def stamp(df, *columns):
    return df.withColumns({c: F.timestamp_millis(c) for c in columns})


# --- upserts ---------------------------------------------------------------------------------


def test_first_wins_keeps_existing_and_earliest(spark):
    old = spark.createDataFrame([("a", "old", 0)], "k string, v string, at int")
    new = spark.createDataFrame([("a", "late", 1), ("b", "second", 3), ("b", "first", 2)], old.schema)
    got = upsert.upsert_first(old, new, ["k"], [F.col("at")])
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [("a", "old"), ("b", "first")]


def test_last_wins_replaces(spark):
    old = spark.createDataFrame([("a", "old", 9), ("c", "kept", 1)], "k string, v string, at int")
    new = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], old.schema)
    got = upsert.upsert_last(old, new, ["k"], [F.col("at").desc()])
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [("a", "y"), ("c", "kept")]


def test_richer_wins_matches_row_by_row(spark):
    """Equal or poorer rows change nothing; fixed columns keep their first value."""
    import itertools

    schema = "ride_id string, rider_id string, event_seq int, fare_cents long"
    old = [("a", "r0", 3, 30)]
    batch = [("a", "r1", 3, 31), ("a", "r2", 5, 52), ("a", "r3", 5, 53), ("a", "r4", 4, 44), ("b", "r5", 1, 1), ("b", "r6", 2, None)]
    for order in itertools.islice(itertools.permutations(range(len(batch))), 0, 720, 150):
        table = {r[0]: list(r) for r in old}
        rows = [batch[i] for i in order]
        for ride, rider, seq, fare in rows:
            if ride not in table:
                table[ride] = [ride, rider, seq, fare]
            elif seq > table[ride][2]:
                table[ride][2:] = [seq, fare]
        new = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema + ", arrival long")
        got = upsert.upsert_richer(spark.createDataFrame(old, schema), new)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, table.values()))


# --- joins -----------------------------------------------------------------------------------


def sessions_and_payments(spark):
    sessions = stamp(
        spark.createDataFrame(
            [("a", 1, "completed", T0, 10, T0), ("b", 1, "completed", T0, 20, T0), ("c", 1, "cancelled", T0, None, T0),
             ("d", 1, "abandoned", None, None, T0), ("e", 1, "completed", T0, 5, T0)],
            "ride_id string, city_id int, terminal_state string, ended_ts long, fare_cents long, session_ts long",
        ),
        "ended_ts",
        "session_ts",
    )
    payments = stamp(
        spark.createDataFrame(
            [("t1", "a", 10, T0), ("t2", "a", 10, T0 + 900_000), ("t3", "b", 20, T0 + 900_001), ("t4", "e", 5, T0 - 1), ("t5", "d", 1, T0 + 1999)],
            "txn_id string, ride_id string, amount_cents long, payment_ts long",
        ),
        "payment_ts",
    ).withColumns({"status": F.lit("completed"), "method": F.lit("card")})
    return sessions, payments


def test_interval_bounds_are_inclusive(spark):
    got = {r["txn_id"]: r["payment_delay_sec"] for r in joins.ride_payments(*sessions_and_payments(spark)).collect()}
    assert got == {"t1": 0.0, "t2": 900.0, "t5": None}


def test_unpaid_rides(spark):
    got = joins.unpaid_rides(*sessions_and_payments(spark))
    assert sorted(r["ride_id"] for r in got.collect()) == ["b", "e"]


def test_left_join_with_a_hot_right_key(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, a string")
    right = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    got = joins.left_join_unique(left, right, "k")
    assert got.count() == 1002 and got.where("b IS NULL").count() == 2


def test_orphans_let_nulls_pass(spark):
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "c int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert [tuple(r) for r in joins.orphans(child, parent, "c", "p").collect()] == [(5, 2)]


# --- dimensions and facts ----------------------------------------------------------------------


def test_scd2_versions(spark):
    def source(*rows):
        return spark.createDataFrame(rows, "driver_id string, city_id int, status string, tier string, completed_rides int")

    def run(history, src, at):
        return scd2.scd2_merge(history, src, "driver_id", marts.SNAPSHOT_CHECKED, F.timestamp_millis(F.lit(at)))

    first = source(("a", 1, "idle", None, 0), ("b", 1, "idle", "gold", 9))
    history = run(scd2.empty_history(first), first, 1000)
    history = run(history, source(("a", 1, "idle", None, 3), ("b", 2, "idle", "gold", 9)), 2000)
    history = run(history, source(("a", 1, "idle", "gold", 3), ("c", 1, "idle", "gold", 9)), 3000)
    got = sorted((r["driver_id"], r["completed_rides"], r["valid_from"], r["valid_to"]) for r in collect(history))
    assert got == [("a", 0, 1000, 3000), ("a", 3, 3000, None), ("b", 9, 1000, 2000), ("b", 9, 2000, None), ("c", 9, 3000, None)]
    dim = marts.dim_drivers(history.withColumn("last_seen_at", F.lit(None).cast("timestamp")))
    assert dim.where("is_current").count() == 3
    assert dim.where("driver_id = 'c'").first()["driver_version_key"] == "c.19700101000003000"


def test_fact_first_run_takes_everything(spark):
    rows = stamp(spark.createDataFrame([("a", T0), ("b", T0 - 10**9)], "ride_id string, requested_at long"), "requested_at")
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in marts.FACT_COLUMNS if c not in rows.columns})
    empty = rows.where(F.lit(False)).select(*marts.FACT_COLUMNS)
    assert marts.merge_fact(empty, rows).count() == 2
    # The lookback bound is inclusive: exactly 60 minutes before the newest still refreshes.
    edge = rows.select(*marts.FACT_COLUMNS).withColumn("requested_at", F.timestamp_millis(
        F.when(F.col("ride_id") == "a", T0).otherwise(T0 - 3_600_000)))
    fresh = edge.withColumn("city_name", F.lit("new"))
    assert marts.merge_fact(edge, fresh).where("city_name = 'new'").count() == 2
    older = edge.withColumn("requested_at", F.when(F.col("ride_id") == "b", F.timestamp_millis(F.lit(T0 - 3_600_001))).otherwise(F.col("requested_at")))
    assert marts.merge_fact(older, older.withColumn("city_name", F.lit("new"))).where("city_name = 'new'").count() == 1


# --- quality -----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "history,want",
    [([], (0, None)), ([1000, 5000, 4800], (5000, 20_200)), ([10_000] * 10, (10_000, 41_000)), ([3, 4], (4, 1012)),
     ([100, 50_000], (50_000, 101_200)), ([10, 10, 90_000], (90_000, 91_000))],
)
def test_row_count_bounds(spark, history, want):
    df = spark.createDataFrame([(h,) for h in history], "observed long")
    assert tuple(quality.row_count_bounds(df).first()) == want


def dq_rows(spark, rows):
    df = spark.createDataFrame(rows, "run_id string, run_at long, suite string, expectation string, column_name string, success boolean, observed string")
    return stamp(df, "run_at").withColumn("mode", F.lit("warn"))


def test_history_keeps_the_last_ten_in_order(spark):
    rows = [(str(i), i * 1000, "fct_rides", quality.NAMES["row_count"], None, True, str(i)) for i in range(12)]
    rows.append(("bad", 99_000, "fct_rides", quality.NAMES["row_count"], None, True, "not a number"))
    got = [r["observed"] for r in quality.row_count_history(dq_rows(spark, rows), "fct_rides").collect()]
    assert got == [3, 4, 5, 6, 7, 8, 9, 10, 11]


def test_latest_run_lists_failures_or_null(spark):
    rows = [("1", 1000, "a", "x", "c", False, None), ("2", 2000, "a", "x", "c", False, None), ("2", 2000, "a", "y", None, False, None),
            ("2", 2000, "a", "z", None, True, None), ("1", 1000, "b", "x", None, True, None)]
    got = {r["suite"]: r for r in dashboards.latest_quality(dq_rows(spark, rows)).collect()}
    assert got["a"]["failed"] == ["x [c]", "y"] and (got["a"]["n_pass"], got["a"]["n_expectations"]) == (1, 3)
    assert got["b"]["failed"] is None


def test_suite_results_and_gate(spark):
    df = stamp(spark.createDataFrame([("a", 1.0, T0), ("a", None, T0), (None, 9.0, T0)], "k string, v double, ingested_at long"), "ingested_at")
    suite = [
        quality.Expectation("unique", "k"),
        quality.Expectation("not_null", "k"),
        quality.Expectation("between", "v", low=0, high=5),
        quality.Expectation("in_set", "k", ("a",)),
        quality.Expectation("row_count", low=4),
        quality.Expectation("max_between", "ingested_at", low=F.timestamp_millis(F.lit(T0))),
        quality.Expectation("columns", values=("k", "v")),
    ]
    results = quality.run_suite(df, "s", suite, F.lit("1"), F.current_timestamp(), "fail")
    got = [(r["success"], r["unexpected_count"]) for r in results.collect()]
    assert got == [(False, 2), (False, 1), (False, 1), (True, 0), (False, None), (True, None), (False, None)]
    assert set(results.columns) == set(DQ_RESULT.names)
    assert quality.suite_summary(results).first()["pass_rate"] == pytest.approx(2 / 7)
    assert quality.gate(results, "warn") == 5
    with pytest.raises(quality.QualityFailure):
        quality.gate(results, "fail")
    assert quality.gate(results.where("success"), "fail") == 0


def test_freshness_of_an_empty_table_fails(spark):
    df = stamp(spark.createDataFrame([], "ingested_at long"), "ingested_at")
    suite = [quality.Expectation("max_between", "ingested_at", low=F.current_timestamp()), quality.Expectation("row_count", low=0)]
    got = [r["success"] for r in quality.run_suite(df, "s", suite, F.lit("1"), F.current_timestamp()).collect()]
    assert got == [False, True]


# --- operations ----------------------------------------------------------------------------------


def test_lag_clamps_and_skips_uncommitted(spark):
    ends = spark.createDataFrame([("e", 0, 1000), ("e", 1, 500), ("e", 2, 50), ("e", 3, 10), ("e", 4, 10)], "topic string, partition int, end_offset long")
    rows = [("g", "e", 0, 900), ("g", "e", 1, 500), ("g", "e", 2, 60), ("g", "e", 3, None), ("g", "e", 4, -1001)]
    committed = spark.createDataFrame(rows, "consumer_group string, topic string, partition int, next_offset long")
    got = {r["partition"]: r["lag"] for r in ops.consumer_lag(ends, committed).collect()}
    assert got == {0: 100, 1: 0, 2: 0}


def test_ledger_moves_forward_and_resumes_behind(spark):
    schema = "consumer_group string, topic string, partition int, kafka_offset long"
    old = spark.createDataFrame([("g", "e", 0, 792)], schema)
    new = spark.createDataFrame([("g", "e", 0, 700), ("g", "e", 1, 0)], schema)
    ledger = offsets.advance_ledger(old, new)
    assert {r["partition"]: r["next_offset"] for r in ops.resume_offsets(ledger).collect()} == {0: 793, 1: 1}
    messages = spark.createDataFrame([("e", 0, 792), ("e", 0, 793), ("e", 2, 0)], "topic string, partition int, offset long")
    left = offsets.unprocessed(messages, ledger, "g")
    assert sorted((r["partition"], r["offset"]) for r in left.collect()) == [(0, 793), (2, 0)]


def test_alert_needs_two_unbroken_minutes(spark):
    rows = [("g", "e", 0, s * 1000, lag) for s, lag in [(0, 1001), (60, 2000), (120, 1001), (180, 1000), (240, 5000), (359, 5000)]]
    samples = stamp(spark.createDataFrame(rows, "consumer_group string, topic string, partition int, ts long, lag long"), "ts")
    got = sorted((r["started_at"], r["n_samples"], r["firing"]) for r in collect(ops.lag_alerts(samples, slice_sec=60)))
    assert got == [(0, 3, True), (240_000, 2, False)]
    got = collect(ops.lag_alerts(samples, slice_sec=60, max_gap_sec=100))
    assert sorted((r["started_at"], r["n_samples"]) for r in got) == [(0, 3), (240_000, 1), (359_000, 1)]


def test_target_is_down_only_in_every_home(spark):
    rows = [("j", s * 1000, up) for s in (0, 60, 120) for up in (0, 0)] + [("k", s * 1000, up) for s in (0, 60, 120) for up in (0, 1)]
    samples = stamp(spark.createDataFrame(rows, "job string, ts long, up int"), "ts")
    got = ops.down_alerts(samples).collect()
    assert [(r["job"], r["firing"]) for r in got] == [("j", True)]


def test_counter_restart(spark):
    rows = [("s", t * 1000, v) for t, v in [(0, 100), (10, 130), (20, 5), (400, 35)]]
    samples = stamp(spark.createDataFrame(rows, "service string, ts long, total long"), "ts")
    got = {r["window_start"]: r["per_second"] for r in collect(ops.counter_rates(samples, ["service"], "ts", "total", 300))}
    assert got == {0: pytest.approx(35 / 300), 300_000: pytest.approx(30 / 300)}


def test_audit(spark):
    want = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    have = spark.createDataFrame([("a",), ("a",), ("x",)], "id string")
    assert ops.ledger_audit(want, have, "id").first().asDict() == {"n_missing": 2, "n_unexpected": 1, "n_rows": 3, "n_distinct": 2}


def test_lifecycle(spark):
    assert ops.lifecycle_violations(events_df(spark, full_ride())).count() == 0
    odd = [event("matched", T0, "x"), event("started", T0 + 1, "x"), event("cancelled", T0, "x"), event("completed", T0 + 5, "x")]
    rows = ops.lifecycle_violations(events_df(spark, odd), offsets_per_slice=2)
    got = [r["violation"] for r in rows.orderBy("kafka_offset").collect()]
    assert got == ["first is not requested", "illegal edge", "time runs back", "after terminal"]


def test_late_rows(spark):
    events = [event("requested", T0, "a"), event("requested", T0 + 600_000, "b"), event("matched", T0 + 570_000, "a"), event("matched", T0 + 69_999, "c")]
    got = late.late_events(events_df(spark, events), offsets_per_slice=2)
    assert [(r["ride_id"], r["late_by_sec"]) for r in got.collect()] == [("c", 500)]


def test_imperfections(spark):
    events = [event("requested", T0), event("requested", T0), event("matched", T0 + 40_000), event("started", T0 + 10_000), event("started", T0 + 9_000)]
    got = ops.imperfection_profile(events_df(spark, events), F.col("kafka_offset") == 0).first().asDict()
    assert got == {"kafka_partition": 0, "n_events": 5, "n_out_of_order": 1, "n_late": 1, "n_malformed": 1, "n_null_dropoff": 2, "n_duplicate": 2}


def test_throughput_of_one_moment_is_unknown(spark):
    df = stamp(spark.createDataFrame([(T0,)], "ts long"), "ts")
    assert ops.throughput(df, "ts").first()["rows_per_sec"] is None


def test_seed_columns_have_fixed_types_and_misfits_fail(spark, folder):
    def seed(name, *lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/{name}")
        return seeds.load_seed(spark, f"{folder}/{name}", seeds.CITY_SEED)

    header = "city_id,name,center_lat,center_lon,demand_weight"
    good = seed("good", header, "1,North,1.5,2,0.25", '2,"South, old",,-3.5,1')
    assert good.schema == seeds.CITY_SEED
    assert sorted(map(tuple, good.collect())) == [(1, "North", 1.5, 2.0, 0.25), (2, "South, old", None, -3.5, 1.0)]
    for name, lines in {"value": (header, "one,North,1,2,3"), "header": (header.replace("name", "title"), "1,North,1,2,3")}.items():
        with pytest.raises(Exception):
            seed(name, *lines).collect()


def test_a_batch_meets_its_buckets_without_an_exchange_of_the_table(spark, folder):
    """The batch is shuffled to the buckets; the table is read where it lies, however many batches it has."""
    schema = "id long, v string"
    table = BucketedTable(spark, f"{folder}/t", spark.createDataFrame([], schema).schema, ["id"], buckets=8)
    order = [F.col("v")]
    assert table.insert(spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], schema), "one", order) == 2
    assert table.insert(spark.createDataFrame([(2, "z"), (3, "d")], schema), "two", order) == 1
    assert table.insert(spark.createDataFrame([(9, "x")], schema), "two", order) is None
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert table.insert(spark.range(20_000).select("id", F.lit("many").alias("v")), "three", order) == 19_997
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 4096)
    try:
        rows = spark.range(5000).select("id", F.concat(F.lit("v"), F.col("id")).alias("v"))
        text = table.missing(rows, order)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    # Going up from the table's scan, each operator above it is one step to the left; none up to the join is an exchange.
    above, left = [], lines[scan].index("FileScan")
    for line in reversed(lines[:scan]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < left:
            left = own
            above.append(line.strip(" :+-"))
    upto = next(i for i, line in enumerate(above) if "LeftAnti" in line)
    assert not [line for line in above[:upto] if line.startswith("Exchange")], text


def test_bucketed_rows_of_an_unfinished_batch_are_not_read(spark, folder):
    schema = "id long, v string"
    table = BucketedTable(spark, f"{folder}/t", spark.createDataFrame([], schema).schema, ["id"], buckets=4)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    rows.createOrReplaceTempView("lost_rows")
    spark.sql(f"INSERT INTO {table.name} PARTITION (batch = 'lost') SELECT id, v FROM lost_rows")
    assert table.read().count() == 0
    assert table.insert(rows.limit(0), "lost", [F.col("v")]) == 0 and table.read().count() == 0
    assert table.insert(rows, "next", [F.col("v")]) == 2
    spark.sql(f"DROP TABLE {table.name}")
    again = BucketedTable(spark, f"{folder}/t", rows.schema, ["id"], buckets=4)
    assert sorted(map(tuple, again.read().collect())) == [(1, "a"), (2, "b")], "a new session finds the rows"
