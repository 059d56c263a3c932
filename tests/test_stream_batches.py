"""What a batch function does with its rows: a stream's rows are computed anew by every action, so each is taken once."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareflow.streaming import jobs
from fareflow.streaming.feed import RideFeed
from fareflow.streaming.sources import file_stream
from tests.rides import T0, event, full_ride
from tests.test_streaming import states, wired


def counted(spark, rows, column):
    """The rows, and how often one of their cells was computed."""
    times = spark.sparkContext.accumulator(0)

    def same(x):
        times.add(1)
        return x

    kind = rows.schema[column].dataType
    return rows.withColumn(column, F.udf(same, kind).asNondeterministic()(column)), times


def test_feed_computes_each_message_once(spark, folder):
    rows = wired(spark, [*full_ride("a"), event("requested", T0, "b")], 0)
    rows.coalesce(1).write.parquet(f"{folder}/in")
    messages, times = counted(spark, file_stream(spark, f"{folder}/in", rows.schema), "value")
    write = RideFeed(spark, f"{folder}/feed", f"{folder}/cp")
    jobs.start(messages, f"{folder}/cp", foreach_batch=write).awaitTermination()
    assert states(write) == [("a", "completed", 5)] and write.tables.ledger().first()["kafka_offset"] == 5
    assert times.value == 6
