"""Streaming sources: files everywhere, Kafka where its connector is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob: str | None = None,
    max_files: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A stream over the files that appear in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def kafka_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    """Earliest start, committed records only. Not exercised here: the connector jar is not installed."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Wire messages of a topic (topic, partition, offset, key, value)."""
    source = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kwargs))
    return source.load().select("topic", "partition", "offset", "key", "value")
