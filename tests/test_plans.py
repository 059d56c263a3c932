"""What the plans must look like at scale: no cross joins, no raw rows of a key in one window."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow import checks
from fareflow.operators import latest, quantiles
from fareflow.plans.build import MartStore
from fareflow.sources.derived import DriverTables
from fareflow.sources.versions import KeyedTable

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
RUNS_AT_BUILD = ("stream_", "lake_", "keyed_", "mart_")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(checks.queries()) if not n.startswith(RUNS_AT_BUILD)])
def test_no_cross_join_and_no_single_task_window(spark, name):
    text = plan(checks.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A window without a partition pulls its input into one task. Two kinds may: the spans of a quantile over
    # everything, two for each quantile and one more, and the row-count history with one row per day.
    unpartitioned = re.findall(r"windowspecdefinition\((\S+) (?:ASC|DESC)", text)
    assert all(c.startswith(("_slice#", "run_at#")) for c in unpartitioned)


@pytest.mark.parametrize(
    "name", ["late_events", "lifecycle_violations", "imperfection_profile", "driver_shifts", "ping_sessions",
             "previous_ping", "running_spend", "lag_alerts", "counter_rates"]
)
def test_rows_are_spread_by_key_and_slice(spark, name):
    """Windows over rows partition by slice too; per-key windows see one row per slice only."""
    text = plan(checks.queries()[name](spark, SF))
    for line in re.findall(r"\+- Window \[.*", text):
        over_rows = "_tail" not in line and "_total" not in line and "_opened" not in line
        if over_rows:
            assert "_slice" in line.rsplit("], [", 2)[-2], line


def test_shifts_take_two_scans_and_four_exchanges(spark):
    """The plan as run: rows and slice summaries are exchanged by (key, slice), summaries by key, shifts at the end."""
    found = checks.queries()["driver_shifts"](spark, SF)
    found.collect()
    text = plan(found)
    final = text[: text.index("Initial Plan")] if "Initial Plan" in text else text
    assert final.count("FileScan") <= 2
    assert len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange hashpartitioning", final)) <= 4
    assert "Limit" not in final


def test_latest_rows_are_limited_before_the_shuffle(spark):
    t = DriverTables(spark, SF)
    text = plan(latest.latest_per_key(t.table("orders"), ["o_custkey"], "o_orderdate", "o_orderkey"))
    partial, final = text.index("Partial"), text.index("Final")
    assert final < text.index("Exchange") < partial


def test_fold_shuffles_once(spark):
    text = plan(checks.queries()["session_fold"](spark, SF))
    assert text.count("Exchange hashpartitioning(ride_id") == 1
    assert text.count("Exchange hashpartitioning") == 1


def test_scan_reads_only_what_it_needs(spark):
    t = DriverTables(spark, SF)
    rows = quantiles.exact_quantiles(t.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"p": 0.5})
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan(rows)))
    assert schemas == {"l_extendedprice:double,l_returnflag:string"}
    assert "PushedFilters: [IsNotNull(l_extendedprice)" in plan(rows)


def test_lookback_bound_is_a_scalar_subquery(spark):
    text = plan(checks.queries()["rides_per_minute"](spark, SF))
    assert "scalar-subquery" in text or "Subquery" in text
    assert "Join" not in text


def test_an_incremental_run_scans_the_look_back_days_only(spark, folder):
    """Bound and touched keys of the fact come from the days the look-back reaches, not from the whole target."""
    store = MartStore(spark, folder)
    schema = T.StructType([T.StructField("ride_id", T.StringType()), T.StructField("requested_at", T.TimestampType()),
                           T.StructField("requested_day", T.DateType())])
    table = KeyedTable(spark, f"{folder}/t", schema, ["requested_day"], ["ride_id"])
    assert store.look_back(table) is None
    days = spark.range(20).select(F.col("id").cast("string").alias("ride_id"),
                                  F.expr("timestamp'2026-01-01 00:20:00' + make_dt_interval(id)").alias("requested_at"))
    table.append(days.withColumn("requested_day", F.to_date("requested_at")), "1")
    since, within = store.look_back(table)
    assert days.where(F.col("requested_at") >= since).count() == 1
    stored = table.holding(days, within)
    text = plan(stored)
    assert re.search(r"PartitionFilters: \[[^\]]*requested_day#\d+ >= 2026-01-19", text), text
    assert sorted(r["ride_id"] for r in stored.collect()) == ["18", "19"]


def test_small_seed_is_broadcast_by_its_known_size(spark):
    t = DriverTables(spark, SF)
    named = t.ride_events.join(t.cities, "city_id").select(F.count("name"))
    assert "BroadcastHashJoin" in plan(named)
