"""Seed tables: small CSV files with a header and fixed column types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CITY_SEED = T.StructType(
    [
        T.StructField("city_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("center_lat", T.DoubleType()),
        T.StructField("center_lon", T.DoubleType()),
        T.StructField("demand_weight", T.DoubleType()),
    ]
)


def load_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file read under ``schema``; a header or a value that does not fit fails the read."""
    options = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST"}
    return spark.read.schema(schema).options(**options).csv(path)
