"""Results to and from a database over JDBC, where its driver jar is installed.

Not exercised here: no driver jar is on the class path. A plain JDBC write cannot upsert, so a batch
goes to a staging table named after it and the database merges from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, url: str, table: str, split: tuple[str, str, str, int] | None = None, **options: str
) -> DataFrame:
    """A table, read in parallel when ``split`` gives (column, lower, upper, partitions)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if split is not None:
        column, lower, upper, partitions = split
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def write_batch(df: DataFrame, url: str, table: str, batch_id: int, **options: str) -> str:
    """Overwrite the batch's staging table and return its name; a replay writes the same one."""
    staging = f"{table}_batch_{batch_id}"
    df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=staging, **options).save()
    return staging
