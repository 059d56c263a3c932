"""Several tables whose rows of one micro-batch become visible together."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators import offsets
from fareflow.sources.versions import path_missing

#: One ledger row for each source partition that a batch read.
LEDGER = T.StructType(
    [
        T.StructField("consumer_group", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("newest", T.TimestampType()),
        T.StructField("stream", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query; a new checkpoint has a new one."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").agg(F.concat_ws("", F.collect_list("value"))).first()[0]
    return json.loads(text)["id"]


class BatchTables:
    """Tables under ``root`` and one ledger of positions for all of them.

    A batch is named after its query and its number, so batches of another checkpoint lie beside it. The rows of
    all tables are written first, and one ledger entry last, in one file, so that it appears by one rename; readers of any
    table take only batches in the ledger. A batch that is committed is left as it is when it comes again; one that
    was stopped before its entry is in no table, and is written anew.
    """

    def __init__(self, spark: SparkSession, root: str, consumer_group: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.ledger_path = f"{self.root}/ledger"
        self.consumer_group = consumer_group

    def path(self, table: str, batch: str) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def entries(self) -> DataFrame:
        """Ledger rows of all committed batches."""
        try:
            return self.spark.read.schema(LEDGER).parquet(self.ledger_path)
        except AnalysisException as error:
            if not path_missing(error):
                raise
            return self.spark.createDataFrame([], LEDGER)

    def is_committed(self, batch: str) -> bool:
        return not self.entries().where(F.col("batch") == batch).isEmpty()

    def last_batch(self, stream: str, before: int) -> str | None:
        """The newest committed batch of a stream among those with a smaller number."""
        own = self.entries().where((F.col("stream") == stream) & (F.col("number") < before))
        return own.agg(F.max_by("batch", "number")).first()[0]

    def newest_times(self, stream: str, before: int) -> DataFrame:
        """Newest event time of each source partition that a stream's earlier batches brought: one row a partition."""
        own = self.entries().where((F.col("stream") == stream) & (F.col("number") < before))
        return own.groupBy(F.col("partition").alias("kafka_partition")).agg(F.max("newest").alias("newest_before"))

    def write(
        self, stream: str, number: int, tables: Mapping[str, DataFrame], messages: DataFrame, newest: DataFrame | None = None
    ) -> None:
        """Write a batch's rows of all tables, then its ledger entry.

        ``messages``: topic, partition, offset of all it read; ``newest``: kafka_partition and newest event time.
        """
        batch = f"{stream}-{number}"
        if self.is_committed(batch):
            return
        for table, rows in tables.items():
            rows.write.mode("overwrite").parquet(self.path(table, batch))
        self.commit(batch, self._entry(stream, number, messages, newest))

    def _entry(self, stream: str, number: int, messages: DataFrame, newest: DataFrame | None) -> DataFrame:
        done = offsets.batch_offsets(messages, self.consumer_group)
        if newest is None:
            done = done.withColumn("newest", F.lit(None).cast("timestamp"))
        else:
            done = done.join(newest.withColumnRenamed("kafka_partition", "partition"), "partition", "left")
        named = done.withColumns({"stream": F.lit(stream), "number": F.lit(number).cast("long")})
        return named.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields if f.name != "batch"])

    def commit(self, batch: str, entry: DataFrame) -> None:
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.ledger_path}/batch={batch}")

    def read(self, table: str, stream: str | None = None) -> DataFrame:
        """The table's rows of all committed batches (of one stream), with their ``batch``; other folders are not opened."""
        entries = self.entries() if stream is None else self.entries().where(F.col("stream") == stream)
        committed = entries.select("batch").distinct()
        return self.spark.read.parquet(f"{self.root}/{table}").join(committed, "batch", "left_semi")

    def ledger(self) -> DataFrame:
        """How far each partition has been read."""
        return self.entries().groupBy(*offsets.LEDGER_KEYS).agg(F.max("kafka_offset").alias("kafka_offset"))
