"""Helpers the text operators share: reading tables, scratch folders, row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: what reads the result never recomputes it, whichever executor is lost.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as by ``written``, packed tighter, and the folder, which ``dropped`` removes again."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    # The step's shuffle files go once the driver has forgotten the step.
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Remove folders of steps whose results have been written on."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def text_key(text: str = "text") -> Column:
    """64-bit hash of a text; null hashes like no other text of its length can be told from ''."""
    return F.xxhash64(F.col(text), F.col(text).isNull())


def parts_for(rows: int, per_part: int) -> int:
    """Number of parts of at most ``per_part`` rows each, on average."""
    return max(1, -(-rows // per_part))


def free_name(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Names like ``wanted`` that no column of ``df`` has, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
