"""One run of the marts: incremental fact, rollup, shifts, driver history, quality results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.times import seconds
from fareflow.operators import quality
from fareflow.operators.scd2 import empty_history, scd2_merge
from fareflow.operators.shifts import joined_shifts, shift_parts
from fareflow.operators.upsert import replace_keys
from fareflow.plans import marts
from fareflow.schemas import DQ_RESULT, FACT_LOOKBACK_SEC
from fareflow.sources.versions import KeyedTable, VersionedTable


@dataclass(frozen=True)
class Marts:
    """The tables as a run left them."""

    fct_rides: DataFrame
    agg_city_hourly: DataFrame
    fct_driver_shifts: DataFrame
    dim_cities: DataFrame
    dim_drivers: DataFrame
    dq_results: DataFrame


class MartStore:
    """Marts under ``root``, a folder every executor can reach.

    The fact is merged by request day, so a run rewrites only the days its look-back touches. Open
    driver versions are rewritten, closed ones only added to. Every write is keyed by the run's
    name: a run that is started again after a loss changes nothing twice.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _keyed_fact(self, schema: T.StructType) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/fct_rides", schema, ["requested_day"], ["ride_id"])

    def _stored(self, df: DataFrame, name: str, run: str) -> DataFrame:
        path = f"{self.root}/{name}/run={run}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def run(
        self,
        run: str,
        run_at: Column,
        sessions: DataFrame,
        payments: DataFrame,
        pings: DataFrame,
        cities: DataFrame,
        ping_order: Sequence[str] = ("ts",),
        freshness_minutes: int = 30,
        mode: str = "warn",
    ) -> Marts:
        """Build everything from landed sessions (with ``ingested_at``), payments, pings and cities."""
        dim_cities = marts.dim_cities(cities)
        staged = marts.stage_sessions(sessions)
        enriched = marts.enriched_rides(staged, marts.stage_payments(payments), dim_cities)
        rides = self._merge_rides(run, enriched)
        hourly = self._stored(marts.city_hourly(rides), "agg_city_hourly", run)
        # Kept between its two halves, so that the pings are read and sorted once.
        parts = self._stored(shift_parts(pings, ping_order), "int_shift_parts", run)
        shifts = self._stored(joined_shifts(parts), "fct_driver_shifts", run)
        newest = ["pinged_at" if c == "ts" else c for c in ping_order]
        drivers = marts.current_drivers(marts.stage_locations(pings), staged, newest)
        history = self._snapshot_drivers(run, run_at, drivers)
        results = self._check_rides(run, run_at, rides, freshness_minutes, mode)
        return Marts(rides, hourly, shifts, dim_cities, marts.dim_drivers(history), results)

    def _merge_rides(self, run: str, enriched: DataFrame) -> DataFrame:
        dated = enriched.withColumn("requested_day", F.to_date("requested_at"))
        columns = [*marts.FACT_COLUMNS, "requested_day"]
        table = self._keyed_fact(dated.select(*columns).schema)
        bound = self.look_back(table)
        if bound is None:
            table.append(dated.select(*columns), run)
        else:
            # A ride keeps its request, so its stored row lies in the same days.
            since, within = bound
            batch = dated.where(F.col("requested_at") >= since).select(*columns)
            table.merge(batch, run, lambda old, new: replace_keys(old, new, ["ride_id"]), within)
        return table.read().select(*marts.FACT_COLUMNS)

    @staticmethod
    def look_back(table: KeyedTable, lookback_sec: int = FACT_LOOKBACK_SEC) -> tuple[Column, Column] | None:
        """Where a run of the fact begins: a moment, and the condition on the days that hold rows from then on.

        That is the newest stored request less the look-back. The ledger names the newest day, and only that day's
        partition is read; one moment reaches the driver. None for an empty table.
        """
        day = table.newest_partition("requested_day")
        if day is None:
            return None
        since = F.max("requested_at") - seconds(lookback_sec)
        found = table.read().where(F.col("requested_day") == F.lit(day)).agg(F.unix_micros(since).alias("at"), F.to_date(since).alias("day"))
        at = found.first()
        return F.timestamp_micros(F.lit(at["at"])), F.col("requested_day") >= F.lit(at["day"])

    def _snapshot_drivers(self, run: str, run_at: Column, drivers: DataFrame) -> DataFrame:
        schema = empty_history(drivers).withColumn("is_open", F.lit(True)).schema
        table = VersionedTable(self.spark, f"{self.root}/drivers_history", schema, ["is_open"])

        def merged(open_rows: DataFrame) -> DataFrame:
            rows = scd2_merge(
                open_rows.drop("is_open"), drivers, "driver_id", marts.SNAPSHOT_CHECKED, run_at
            )
            return rows.withColumn("is_open", F.col("valid_to").isNull())

        table.rewrite(self.spark.range(1).select(F.lit(True).alias("is_open")), merged, run)
        return table.read().drop("is_open")

    def _check_rides(
        self, run: str, run_at: Column, rides: DataFrame, freshness_minutes: int, mode: str
    ) -> DataFrame:
        table = VersionedTable(self.spark, f"{self.root}/dq_results", DQ_RESULT, ["suite"])
        history = quality.row_count_history(table.read(), "fct_rides")
        bounds = quality.row_count_bounds(history)
        suite = quality.ride_fact_suite(
            bounds.select("floor").scalar(),
            bounds.select("ceiling").scalar(),
            run_at - F.make_dt_interval(mins=F.lit(freshness_minutes)),
        )
        results = quality.run_suite(rides, "fct_rides", suite, F.lit(run), run_at, mode)
        table.append(results, run)
        mine = table.read().where(F.col("run_id") == run)
        quality.gate(mine, mode)
        return table.read()
