"""Partitioned Parquet tables with snapshots: data folders plus a ledger written last.

Data files lie under ``data/batch=…/<partition columns>``. A ledger table names the partitions
each snapshot added or removed. Readers open the folders of its live batches alone and join on it, so they
never see a batch that did not finish, and a replayed batch overwrites its own folder. Partition values may be null.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators.slices import null_safe_join
from fareflow.operators.upsert import insert_missing

MIN_FILES = 4


class RowCountChanged(RuntimeError):
    """A rewrite would lose or add rows; nothing was committed."""


@dataclass(frozen=True)
class Compaction:
    partitions_total: int
    partitions_compacted: int
    files_before_total: int
    files_after_total: int
    dry_run: bool


def path_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class VersionedTable:
    """One table at ``root``, a folder every executor can reach. One writer at a time."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, partition: Sequence[str]
    ) -> None:
        self.spark = spark
        self.schema = schema
        self.partition = list(partition)
        self.place = ["batch", *self.partition]
        self.data = f"{root.rstrip('/')}/data"
        self.ledger = f"{root.rstrip('/')}/ledger"
        self.ledger_schema = T.StructType(
            [
                T.StructField("batch", T.StringType()),
                *[schema[c] for c in self.partition],
                T.StructField("n_rows", T.LongType()),
                T.StructField("op", T.StringType()),
                T.StructField("table_schema", T.StringType()),
                T.StructField("snapshot", T.LongType()),
            ]
        )

    # --- reading -------------------------------------------------------------------------

    def entries(self, snapshot: int | None = None) -> DataFrame:
        """Ledger rows up to a snapshot: which one added or removed which batch partition."""
        try:
            rows = self.spark.read.schema(self.ledger_schema).parquet(self.ledger)
        except AnalysisException as error:
            if not path_missing(error):
                raise
            return self.spark.createDataFrame([], self.ledger_schema)
        return rows if snapshot is None else rows.where(F.col("snapshot") <= snapshot)

    def state(self, snapshot: int | None = None) -> tuple[int, T.StructType]:
        """Newest snapshot (0 before the first) and the schema it was written with."""
        row = self.entries(snapshot).agg(F.max(F.struct("snapshot", "table_schema"))).first()[0]
        if row is None:
            return 0, self.schema
        return row[0], T.StructType.fromJson(json.loads(row[1]))

    def alive(self, snapshot: int | None = None) -> DataFrame:
        """Batch partitions that make up a snapshot, with their row counts."""
        last = F.max_by(F.struct("op", "n_rows"), F.col("snapshot")).alias("last")
        return (
            self.entries(snapshot)
            .groupBy(*self.place)
            .agg(last)
            .where(F.col("last.op") == "add")
            .select(*self.place, F.col("last.n_rows").alias("n_rows"))
        )

    def _files(self, schema: T.StructType, batches: Sequence[str]) -> DataFrame:
        """Rows of some batches, committed or not; columns a file lacks read as null."""
        stored = [f for f in schema.fields if f.name not in self.partition]
        places = [T.StructField("batch", T.StringType()), *[schema[c] for c in self.partition]]
        columns = T.StructType([*stored, *places])
        if not batches:
            return self.spark.createDataFrame([], columns)
        reader = self.spark.read.schema(columns).option("basePath", self.data)
        return reader.parquet(*[f"{self.data}/batch={batch}" for batch in batches])

    def _live_files(self, schema: T.StructType, snapshot: int | None) -> DataFrame:
        """Rows of a snapshot's partitions, from the folders of its live batches (one name a batch is gathered)."""
        live = self.alive(snapshot).select(*self.place)
        batches = sorted(r["batch"] for r in live.select("batch").distinct().collect())
        return null_safe_join(self._files(schema, batches), live, self.place, "left_semi")

    def _in(self, rows: DataFrame, partitions: DataFrame) -> DataFrame:
        """The rows in any of the listed partitions; null matches null."""
        return null_safe_join(rows, partitions.select(*self.partition), self.partition, "left_semi")

    def _listed(self, rows: DataFrame, places: Sequence[Row]) -> DataFrame:
        """The rows with any of the given values in each partition column; null matches null. The values are literals, so a scan prunes."""
        for c in self.partition:
            known = {p[c] for p in places}
            among = F.col(c).isin(*[F.lit(v).cast(self.schema[c].dataType) for v in known - {None}])
            rows = rows.where(among | F.col(c).isNull() if None in known else among)
        return rows

    def read(self, snapshot: int | None = None) -> DataFrame:
        """Rows of a snapshot (the newest by default) under that snapshot's schema."""
        _, schema = self.state(snapshot)
        return self._live_files(schema, snapshot).select(*schema.names)

    def newest_partition(self, column: str) -> object:
        """Largest value of a partition column, from the ledger alone; None for an empty table."""
        return self.alive().agg(F.max(column)).first()[0]

    def inventory(self, snapshot: int | None = None) -> DataFrame:
        """Files, bytes and rows per partition; reads file footers, no data columns."""
        live = self._live_files(self.schema, snapshot).select(
            *self.partition,
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
        )
        files = live.groupBy(*self.partition, "path").agg(
            F.max("size").alias("bytes"), F.count(F.lit(1)).alias("rows")
        )
        return files.groupBy(*self.partition).agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("bytes").alias("bytes"),
            F.sum("rows").alias("rows"),
        )

    # --- writing -------------------------------------------------------------------------

    def is_committed(self, batch: str) -> bool:
        return not self.entries().where(F.col("batch") == batch).isEmpty()

    def _write(self, rows: DataFrame, batch: str) -> DataFrame:
        """Write a batch's files and return its ledger rows, counted from the files."""
        # Rebalancing gives a partition one writer, or several where it outgrows the advisory size.
        balanced = rows.hint("rebalance", *[F.col(c) for c in self.partition])
        writer = balanced.write.mode("overwrite").partitionBy(*self.partition)
        writer.parquet(f"{self.data}/batch={batch}")
        counted = self._files(self.schema, [batch]).groupBy(*self.place)
        return counted.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("op", F.lit("add"))

    def _commit(self, entries: DataFrame, schema: T.StructType) -> int | None:
        """Make the entries the next snapshot; none without entries.

        One row per touched partition, one file, so that the commit is one rename.
        """
        if entries.isEmpty():
            return None
        snapshot = self.state()[0] + 1
        rows = entries.withColumn("table_schema", F.lit(schema.json()))
        rows.coalesce(1).write.mode("errorifexists").parquet(f"{self.ledger}/snapshot={snapshot}")
        return snapshot

    def append(self, rows: DataFrame, batch: str) -> int | None:
        """Add rows as a new snapshot; a batch that is already there is skipped."""
        if self.is_committed(batch):
            return None
        _, schema = self.state()
        return self._commit(self._write(rows.select(*schema.names), batch), schema)

    def rewrite(
        self, touched: DataFrame, change: Callable[[DataFrame], DataFrame], batch: str
    ) -> int | None:
        """Replace the touched partitions by ``change`` of their rows; the others stay as they are.

        ``touched`` lists partition values and may repeat them. Rows that ``change`` moves must stay inside them.
        """
        if self.is_committed(batch):
            return None
        _, schema = self.state()
        # One row a partition is gathered, so that the others' files are not read.
        touched = touched.select(*self.partition).distinct()
        places = touched.collect()
        old, gone = self._listed(self.read(), places), self._listed(self.alive(), places)
        if len(self.partition) > 1:  # values that do not come together
            listed = self.spark.createDataFrame(places, touched.schema)
            old, gone = self._in(old, listed), self._in(gone, listed)
        added = self._write(change(old).select(*schema.names), batch)
        return self._commit(gone.withColumn("op", F.lit("remove")).unionByName(added), schema)

    def compact(self, min_files: int = MIN_FILES, dry_run: bool = False) -> Compaction:
        """Rewrite partitions that hold more than ``min_files`` files into fewer, larger ones.

        All such partitions are rewritten in one job. Rows per partition must agree with the
        ledger before and with the new files after, or nothing is committed. Old snapshots stay
        readable.
        """
        before = self.inventory()
        many = F.col("files") > min_files
        partitions, chosen, n_files, chosen_files = before.agg(
            F.count(F.lit(1)),
            F.count_if(many),
            F.coalesce(F.sum("files"), F.lit(0)),
            F.coalesce(F.sum(F.when(many, F.col("files"))), F.lit(0)),
        ).first()
        if dry_run or chosen == 0:
            return Compaction(partitions, 0, n_files, n_files, dry_run)
        snapshot, schema = self.state()
        batch = f"compact-{snapshot + 1}"
        candidates = before.where(many).select(*self.partition, F.col("rows").alias("n"))
        live = self._in(self.alive(), candidates)
        in_ledger = live.groupBy(*self.partition).agg(F.sum("n_rows").alias("n"))
        self._same_counts(in_ledger, candidates)
        rows = self._in(self.read(), candidates)
        added = self._write(rows, batch)
        self._same_counts(in_ledger, added.select(*self.partition, F.col("n_rows").alias("n")))
        self._commit(live.withColumn("op", F.lit("remove")).unionByName(added), schema)
        paths = self._files(self.schema, [batch]).select(F.col("_metadata.file_path").alias("path"))
        after = paths.distinct().count()
        return Compaction(partitions, chosen, n_files, n_files - chosen_files + after, dry_run)

    def expire(self, keep: Sequence[int] = ()) -> int:
        """Delete the data of batches that neither the newest snapshot nor one in ``keep`` reads; how many.

        Snapshots that read a deleted batch can be read no more. The ledger keeps its history.
        """
        kept = {r["batch"] for s in (None, *keep) for r in self.alive(s).select("batch").distinct().collect()}
        stored = {r["batch"] for r in self.entries().where("op = 'add'").select("batch").distinct().collect()}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        paths = [jvm.org.apache.hadoop.fs.Path(f"{self.data}/batch={batch}") for batch in sorted(stored - kept)]
        return sum(path.getFileSystem(conf).delete(path, True) for path in paths)

    def _same_counts(self, expected: DataFrame, found: DataFrame) -> None:
        pairs = null_safe_join(expected, found.withColumnRenamed("n", "m"), self.partition, "full_outer")
        wrong = pairs.where(~F.col("n").eqNullSafe(F.col("m"))).take(1)
        if wrong:
            raise RowCountChanged(f"row counts disagree, for one: {wrong[0]}")


class KeyedTable(VersionedTable):
    """A versioned table with a key, merged by rewriting only the partitions a batch touches."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        partition: Sequence[str],
        keys: Sequence[str],
    ) -> None:
        super().__init__(spark, root, schema, partition)
        self.keys = list(keys)

    def insert(self, rows: DataFrame, batch: str, order: Sequence[Column]) -> int | None:
        """First wins: only rows with new keys are added; nothing is rewritten."""
        return self.append(insert_missing(self.read(), rows, self.keys, order), batch)

    def holding(self, rows: DataFrame, within: Column | None = None) -> DataFrame:
        """Stored rows that have a key of ``rows``; ``within``, a condition on partition columns, prunes the scan."""
        stored = self.read() if within is None else self.read().where(within)
        return stored.join(rows.select(*self.keys), self.keys, "left_semi")

    def merge(
        self,
        rows: DataFrame,
        batch: str,
        combine: Callable[[DataFrame, DataFrame], DataFrame],
        within: Column | None = None,
    ) -> int | None:
        """Replace touched partitions by ``combine(their rows, the batch)``.

        Touched are the partitions of the batch and those that hold one of its keys. ``within`` says in which
        partitions its keys can be, where that is known; the others are not looked at.
        """
        rows = rows.persist()
        try:
            holds = self.holding(rows, within)
            touched = rows.select(*self.partition).unionByName(holds.select(*self.partition))
            return self.rewrite(touched, lambda old: combine(old, rows), batch)
        finally:
            rows.unpersist()
