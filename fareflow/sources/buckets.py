"""A keyed table whose rows lie in buckets of their key: a batch meets them without an exchange of the table."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators.upsert import insert_missing
from fareflow.sources.versions import path_missing

#: Buckets of a table; no fewer than a batch's shuffle partitions, or Spark would rather deal the table anew.
BUCKETS = 200


class BucketedTable:
    """Rows under ``root``, first wins by key. One writer at a time.

    Each batch is a partition of a bucketed Parquet table, and its rows are sorted by key in every bucket. So the look-up of
    a batch's keys shuffles the batch to the buckets and reads the key columns of the table where they lie. A batch's rows
    are written first and its ledger entry last; rows of batches without an entry are not read, and a batch that comes again is
    written anew, or skipped once it is in the ledger. The table's name is made from ``root``, and a new session finds
    the partitions there.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS) -> None:
        self.spark, self.keys, self.buckets = spark, list(keys), buckets
        self.root, self.columns = root.rstrip("/"), schema.names
        self.ledger = f"{self.root}/ledger"
        self.name = f"bucketed_{hashlib.sha256(self.root.encode()).hexdigest()[:16]}"
        if not spark.catalog.tableExists(self.name):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            by = ", ".join(f"`{k}`" for k in self.keys)
            store, folder = self._folder("rows")
            store.mkdirs(folder)
            spark.sql(
                f"CREATE TABLE {self.name} ({fields}, batch STRING) USING parquet PARTITIONED BY (batch)"
                f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.root}/rows'"
            )
            spark.catalog.recoverPartitions(self.name)

    def _folder(self, name: str) -> tuple:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def _clear(self, batch: str) -> None:
        """Remove what a lost writer left of a batch that is not in the ledger."""
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (batch = '{batch}')")
        store, folder = self._folder(f"rows/batch={batch}")
        store.delete(folder, True)

    def committed(self) -> DataFrame:
        """Names of the batches in the ledger, one row a batch."""
        try:
            return self.spark.read.schema("n_rows long, batch string").parquet(self.ledger).select("batch").distinct()
        except AnalysisException as error:
            if not path_missing(error):
                raise
            return self.spark.createDataFrame([], "batch string")

    def read(self) -> DataFrame:
        """Rows of the committed batches. The ledger has a row a batch; where Spark broadcasts it, the buckets stay where they are."""
        rows = self.spark.table(self.name).join(self.committed(), "batch", "left_semi")
        return rows.select(*self.columns)

    def missing(self, rows: DataFrame, order: Sequence[Column]) -> DataFrame:
        """The first row of each key that the table does not hold yet."""
        return insert_missing(self.read(), rows, self.keys, order)

    def insert(self, rows: DataFrame, batch: str, order: Sequence[Column]) -> int | None:
        """Add the rows with new keys under a batch name; how many, or None where the batch is there already."""
        if not self.committed().where(F.col("batch") == batch).isEmpty():
            return None
        new = self.missing(rows.select(*self.columns), order)
        # A task a bucket, so that a batch adds one file to each bucket at most.
        placed = new.repartition(self.buckets, *self.keys).select(*self.columns)
        view = f"{self.name}_new"
        placed.createOrReplaceTempView(view)
        self._clear(batch)
        placed.sparkSession.sql(f"INSERT INTO {self.name} PARTITION (batch = '{batch}') SELECT * FROM {view}")
        placed.sparkSession.catalog.dropTempView(view)
        n = self.spark.table(self.name).where(F.col("batch") == batch).agg(F.count(F.lit(1)).alias("n_rows"))
        n.coalesce(1).write.mode("overwrite").parquet(f"{self.ledger}/batch={batch}")
        return self.spark.read.schema("n_rows long").parquet(f"{self.ledger}/batch={batch}").first()[0]
