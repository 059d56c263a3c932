"""From wire messages to sessions: one feed, batch by batch, whose outputs are committed together.

Each micro-batch is decoded once. Its clean rows are mirrored, its poison becomes dead letters, rows behind their
source partition's watermark are listed, and the rides are folded into the open ones. A ride closes in the
batch that brings its terminal event, or that shows its partition's newest event time strictly more than the timeout past
the ride's last one; the watermark is each partition's own, without delay, and only partitions with input are looked at.

What a batch needs of the earlier ones is in the committed tables: the open rides, the closed ones, and the
newest event time of each partition. So a batch that is run again, after a loss or a restart, finds what it found before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.times import seconds, whole_seconds
from fareflow.operators import late, poison
from fareflow.operators.sessions import SLOT_FIELDS, derive_session
from fareflow.schemas import EVENT_ORDINALS, RIDE_EVENT, RIDE_SESSION, SESSION_TIMEOUT_SEC, TERMINAL_TYPES, WATERMARK_DELAY_SEC
from fareflow.sources.versions import path_missing
from fareflow.streaming.commits import BatchTables, stream_id

ORDINALS = tuple(EVENT_ORDINALS.values())
_SLOT = T.StructType([T.StructField(name, RIDE_EVENT[name].dataType) for name in SLOT_FIELDS])
#: An open ride: a slot of values for each ordinal, when it last arrived, and when each terminal type first did.
OPEN_RIDE = T.StructType(
    [
        T.StructField("ride_id", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        *[T.StructField(f"s{n}", _SLOT) for n in ORDINALS],
        *[T.StructField(f"at{n}", T.LongType()) for n in ORDINALS],
        *[T.StructField(f"first_{name}", T.LongType()) for name in TERMINAL_TYPES],
    ]
)


def as_open_rides(events: DataFrame) -> DataFrame:
    """Each event as an open ride that has this event alone."""
    slot, kind = F.struct(*SLOT_FIELDS), F.col("event_type")
    return events.select(
        "ride_id",
        "kafka_partition",
        *[F.when(kind == name, slot).alias(f"s{n}") for name, n in EVENT_ORDINALS.items()],
        *[F.when(kind == name, F.col("kafka_offset")).alias(f"at{n}") for name, n in EVENT_ORDINALS.items()],
        *[F.when(kind == name, F.col("kafka_offset")).alias(f"first_{name}") for name in TERMINAL_TYPES],
    )


def merged_rides(rides: DataFrame) -> DataFrame:
    """One row a ride: of each ordinal the last arrival, of each terminal type the first. Merging again changes nothing."""
    return rides.groupBy("ride_id").agg(
        F.max("kafka_partition").alias("kafka_partition"),
        *[F.max_by(f"s{n}", f"at{n}").alias(f"s{n}") for n in ORDINALS],
        *[F.max(f"at{n}").alias(f"at{n}") for n in ORDINALS],
        *[F.min(f"first_{name}").alias(f"first_{name}") for name in TERMINAL_TYPES],
    )


def late_rows(events: DataFrame, newest_before: DataFrame, delay_sec: int) -> DataFrame:
    """Events older than the watermark they met in their partition, in this batch or the ones before."""
    met = late.with_watermark_before(events, delay_sec).join(newest_before, "kafka_partition", "left")
    watermark = F.greatest("watermark", F.col("newest_before") - seconds(delay_sec))
    return met.withColumn("watermark", watermark).where(F.col("event_ts") < F.col("watermark")).select(
        "event_id", "ride_id", "event_type", "event_ts", "city_id",
        whole_seconds(F.col("event_ts"), F.col("watermark")).alias("late_by_sec"),
    )


class RideFeed:
    """The batch function of the feed. Tables: mirror, letters, late, sessions, ignored, open.

    ``ignored`` has the rows of rides that closed in an earlier batch: closed is final. ``sessions`` says which those
    are; with ``remember_sec``, only sessions from batches that far behind the newest event time are looked up, so that the
    look-up does not grow for ever. A repeated message changes no session. A batch without a clean message closes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        checkpoint: str,
        consumer_group: str = "sessionizer",
        timeout_sec: int = SESSION_TIMEOUT_SEC,
        delay_sec: int = WATERMARK_DELAY_SEC,
        remember_sec: int | None = None,
    ) -> None:
        self.tables = BatchTables(spark, root, consumer_group)
        self.spark, self.checkpoint = spark, checkpoint
        self.timeout_sec, self.delay_sec, self.remember_sec = timeout_sec, delay_sec, remember_sec

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        stream = stream_id(self.spark, self.checkpoint)
        if self.tables.is_committed(f"{stream}-{batch_id}"):
            return
        before = self.tables.newest_times(stream, batch_id)
        decoded = poison.decode_ride_events(messages).persist()
        events = poison.clean_rows(decoded)
        newest = events.groupBy("kafka_partition").agg(F.max("event_ts").alias("newest"))
        newest = newest.join(before, "kafka_partition", "left").select(
            "kafka_partition", F.greatest("newest", "newest_before").alias("newest")
        )
        # A ride closes once, so the look-up adds no rows.
        closed = self._closed(stream).withColumn("was_closed", F.lit(True))
        marked = events.join(closed, "ride_id", "left").persist()
        open_rides = self._open(self.tables.last_batch(stream, batch_id))
        last = F.greatest(*[f"s{n}.event_ts" for n in ORDINALS])
        overdue = F.coalesce(F.col("newest") > last + seconds(self.timeout_sec), F.lit(False))
        terminal = F.coalesce(*[f"first_{name}" for name in TERMINAL_TYPES]).isNotNull()
        rides = merged_rides(open_rides.unionByName(as_open_rides(marked.where("was_closed is null"))))
        rides = rides.join(newest, "kafka_partition", "left").withColumn("closes", terminal | overdue).drop("newest").persist()
        try:
            self.tables.write(
                stream,
                batch_id,
                {
                    "mirror": events,
                    "letters": poison.envelopes(decoded, self.tables.consumer_group, F.current_timestamp()),
                    "late": late_rows(events, before, self.delay_sec),
                    "ignored": marked.where("was_closed").select(*events.columns),
                    "sessions": closed_sessions(rides.where("closes")),
                    "open": rides.where("not closes").select(*OPEN_RIDE.names),
                },
                decoded,
                newest,
            )
        finally:
            for held in (rides, marked, decoded):
                held.unpersist()

    def _open(self, batch: str | None) -> DataFrame:
        """The rides that a batch left open."""
        if batch is None:
            return self.spark.createDataFrame([], OPEN_RIDE)
        return self.spark.read.schema(OPEN_RIDE).parquet(self.tables.path("open", batch))

    def _closed(self, stream: str) -> DataFrame:
        """Ids of the rides that the stream's committed batches closed."""
        try:
            sessions = self.tables.read("sessions", stream)
        except AnalysisException as error:
            if not path_missing(error):
                raise
            return self.spark.createDataFrame([], "ride_id string")
        if self.remember_sec is not None:
            entries = self.tables.entries().where(F.col("stream") == stream)
            recent = entries.agg(F.max("newest") - seconds(self.remember_sec)).scalar()
            batches = entries.groupBy("batch").agg(F.max("newest").alias("newest")).where(F.col("newest") >= recent)
            sessions = sessions.join(batches.select("batch"), "batch", "left_semi")
        return sessions.select("ride_id")


def closed_sessions(rides: DataFrame) -> DataFrame:
    return (
        derive_session(rides)
        .withColumn("terminal_state", F.coalesce("terminal_state", F.lit("abandoned")))
        .select(*RIDE_SESSION.names)
    )
