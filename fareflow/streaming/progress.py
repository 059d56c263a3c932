"""What running queries report of themselves, as rows."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.listener import QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent

PROGRESS = "query string, run string, number long, at timestamp, n_rows long, took_ms long"


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of the last ``most`` micro-batches of a session's queries, until it is drained.

    One row a micro-batch. Nothing runs on the listener's thread but the append; whoever wants the rows drains them into
    a table every now and then.
    """

    def __init__(self, most: int = 100_000) -> None:
        self.waiting: deque[tuple] = deque(maxlen=most)

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        pass

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        took = p.durationMs.get("triggerExecution", 0)
        self.waiting.append((str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, took))

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        pass

    def drained(self, spark: SparkSession) -> DataFrame:
        """The waiting rows, which then wait no more."""
        rows = [self.waiting.popleft() for _ in range(len(self.waiting))]
        texts = spark.createDataFrame(rows, PROGRESS.replace("timestamp", "string"))
        return texts.withColumn("at", F.to_timestamp("at"))


def row_counters(progress: DataFrame) -> DataFrame:
    """Progress as samples of a counter: for each query and batch the rows read so far (query, number, at, n_rows, total).

    A batch that was run again counts once, as it ran last. One row a micro-batch.
    """
    last = progress.groupBy("query", "number").agg(F.max_by(F.struct("at", "n_rows"), "at").alias("last")).select("query", "number", "last.*")
    upto = Window.partitionBy("query").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return last.withColumn("total", F.sum("n_rows").over(upto))
