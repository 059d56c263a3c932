"""Streaming jobs: the batch functions behind watermarks, and exactly-once sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareflow.operators import joins, poison, shifts, windows
from fareflow.operators.sessions import with_session_ts
from fareflow.schemas import WATERMARK_DELAY_SEC
from fareflow.session import ROCKSDB
from fareflow.sources.buckets import BucketedTable
from fareflow.sources.lake import Lake
from fareflow.sources.versions import KeyedTable
from fareflow.streaming.commits import BatchTables, stream_id
from fareflow.streaming.feed import late_rows

DELAY = f"{WATERMARK_DELAY_SEC} seconds"


# --- declarative jobs ------------------------------------------------------------------------


def city_metrics_stream(events: DataFrame) -> DataFrame:
    """One-minute city metrics, emitted once when the watermark passes the window."""
    return windows.city_metrics(events.withWatermark("event_ts", DELAY))


def match_histogram_stream(sessions: DataFrame) -> DataFrame:
    return windows.match_histogram(with_session_ts(sessions).withWatermark("session_ts", DELAY))


def ping_sessions_stream(pings: DataFrame) -> DataFrame:
    return shifts.ping_session_windows(pings.withWatermark("ts", DELAY))


def _watermarked(sessions: DataFrame, payments: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        with_session_ts(sessions).withWatermark("session_ts", DELAY),
        payments.withWatermark("payment_ts", DELAY),
    )


def ride_payments_stream(sessions: DataFrame, payments: DataFrame) -> DataFrame:
    return joins.ride_payments(*_watermarked(sessions, payments))


def unpaid_rides_stream(sessions: DataFrame, payments: DataFrame) -> DataFrame:
    return joins.unpaid_rides_stream(*_watermarked(sessions, payments))


def deduplicated_within_delay(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One row per ``event_id`` among repeats within the delay; rows behind the watermark are dropped.

    For all ids, however late, insert into a keyed table: ``insert_batch``.
    """
    return events.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["event_id"])


# --- running ---------------------------------------------------------------------------------


def start(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start an append query over everything available now; files or a batch function take it."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    writer = stream.writeStream.outputMode("append").trigger(availableNow=True)
    writer = writer.option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        return writer.foreachBatch(foreach_batch).start()
    return writer.format("parquet").start(path)


def run_to_table(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream over what is available, in the folder's checkpoint, and read its output."""
    start(stream, f"{folder}/checkpoint", f"{folder}/out").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


# --- exactly-once sinks ----------------------------------------------------------------------


def split_batch(tables: BatchTables, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """A batch function that decodes wire messages once into the tables ``clean`` and ``dead``, committed together."""

    def write(messages: DataFrame, batch_id: int) -> None:
        decoded = poison.decode_ride_events(messages).persist()
        failed = poison.envelopes(decoded, tables.consumer_group, F.current_timestamp())
        try:
            rows = {"clean": poison.clean_rows(decoded), "dead": failed}
            tables.write(stream_id(tables.spark, checkpoint), batch_id, rows, decoded)
        finally:
            decoded.unpersist()

    return write


def archive_batch(lake: Lake, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """A batch function that archives clean ride events; a replayed batch of the same query is skipped."""

    def write(events: DataFrame, batch_id: int) -> None:
        lake.append(events, f"{stream_id(lake.spark, checkpoint)}-{batch_id}")

    return write


def insert_batch(
    table: KeyedTable | BucketedTable, order: Sequence[Column], checkpoint: str
) -> Callable[[DataFrame, int], None]:
    """A batch function that adds the rows whose key the table does not hold yet, however late they come."""

    def write(rows: DataFrame, batch_id: int) -> None:
        table.insert(rows, f"{stream_id(table.spark, checkpoint)}-{batch_id}", order)

    return write


# --- late side output ------------------------------------------------------------------------


class LateOutput:
    """Rows behind the watermark they met in their source partition, over the batches of a stream.

    Within a batch the watermark runs along the offsets; the newest event times of the stream's earlier batches lie in the
    ledger beside the late rows, so a batch that is run again judges alike, and another checkpoint starts anew.
    """

    def __init__(
        self, spark: SparkSession, root: str, checkpoint: str, delay_sec: int = WATERMARK_DELAY_SEC, topic: str = "rides.events"
    ) -> None:
        self.tables = BatchTables(spark, root, "late")
        self.checkpoint, self.delay_sec, self.topic = checkpoint, delay_sec, topic

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        stream = stream_id(self.tables.spark, self.checkpoint)
        before = self.tables.newest_times(stream, batch_id)
        newest = events.groupBy("kafka_partition").agg(F.max("event_ts").alias("newest"))
        read = events.select(
            F.lit(self.topic).alias("topic"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset")
        )
        self.tables.write(stream, batch_id, {"late": late_rows(events, before, self.delay_sec)}, read, newest)

    def read(self) -> DataFrame:
        return self.tables.read("late").drop("batch")
