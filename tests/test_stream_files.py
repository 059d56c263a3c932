"""The files of the streaming checks: a batch lies in several, and its borders stay."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fareflow.checks import streams
from fareflow.sources.derived import DriverTables


def tables(spark, folder, ids):
    rows = [(i, 1704067200 + 60 * i, i % 7, "view", 1.0, f'{{"k": {i % 100}}}') for i in ids]
    schema = "event_id long, at long, user_id long, event_type string, value double, props string"
    df = spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds("at")).withColumnRenamed("at", "ts")
    df.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return DriverTables(spark, folder)


def batches(spark, folder, stream):
    """Ids and number of read partitions of each micro-batch."""
    seen = []

    def keep(rows, n):
        held = rows.select("event_id", F.spark_partition_id().alias("p")).collect()
        seen.append((sorted(r.event_id for r in held), len({r.p for r in held})))

    streams.jobs.start(stream, f"{folder}/checkpoint", foreach_batch=keep).awaitTermination()
    return seen


@pytest.mark.parametrize("by", ["ts", "event_id", streams.ARRIVAL])
def test_batch_lies_in_several_files(spark, folder, monkeypatch, by):
    monkeypatch.setattr(streams, "FILE_ROWS", 50)
    t = tables(spark, folder, range(800))
    seen = batches(spark, folder, streams._stream(t, by))
    assert len(seen) == streams.FILES and sorted(i for ids, _ in seen for i in ids) == list(range(800))
    assert all(tasks > 1 for _, tasks in seen)
    if by == streams.ARRIVAL:
        last = max(i + i * 7919 % 97 for i in range(800))
        assert all((i + i * 7919 % 97) * streams.FILES // (last + 1) == n for n, (ids, _) in enumerate(seen) for i in ids)
    else:
        assert all(a[0][-1] < b[0][0] for a, b in zip(seen, seen[1:]))


def test_one_batch_of_everything_lies_in_several_files(spark, folder, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    t = tables(spark, folder, range(800))
    ((ids, tasks),) = batches(spark, folder, streams._stream(t, files=1))
    assert ids == list(range(800)) and tasks > 1


def test_batch_of_fewer_rows_than_files_keeps_its_borders(spark, folder, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 10)
    ids = [*range(300), 700, *range(4000, 4100)]  # the second batch has one row, the third has none
    t = tables(spark, folder, ids)
    seen = batches(spark, folder, streams._stream(t, streams.ARRIVAL))
    last = max(i + i * 7919 % 97 for i in ids)
    expected = [[i for i in ids if (i + i * 7919 % 97) * streams.FILES // (last + 1) == n] for n in range(streams.FILES)]
    assert [b for b, _ in seen] == expected
