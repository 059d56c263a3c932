"""Named queries over the driver's tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareflow.sources.derived import DriverTables, sql_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(
    name: str,
    sql: str | None = None,
    uses: tuple[str, ...] = (),
    extra: dict[str, str] | None = None,
) -> Callable[[Callable[[DriverTables], DataFrame]], Callable[[DriverTables], DataFrame]]:
    """Register a query; ``uses`` and ``extra`` name the tables its SQL builds on."""

    def register(fn: Callable[[DriverTables], DataFrame]) -> Callable[[DriverTables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(DriverTables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = (sql_with(uses, extra) if uses or extra else "") + sql
        return fn

    return register
