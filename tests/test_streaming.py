"""Streams over file sources against their batch twins, across batches, restarts and replays."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fareflow.operators import joins, shifts, windows
from fareflow.operators.sessions import build_sessions, with_session_ts
from fareflow.sources.lake import Lake
from fareflow.sources.versions import KeyedTable
from fareflow.streaming import jobs
from fareflow.streaming.commits import BatchTables, stream_id
from fareflow.streaming.feed import RideFeed
from fareflow.streaming.progress import ProgressLog, row_counters
from fareflow.streaming.sessionizer import sessionize
from fareflow.streaming.sources import file_stream, kafka_options
from tests.rides import END, MATCH, START, T0, collect, event, events_df, full_ride

HOURS2 = 2 * 3600 * 1000


def feed(spark, folder, batches, first_offset=0):
    """Write each batch as one more file; with one file per trigger the stream keeps the batches."""
    offset = first_offset
    for events in batches:
        events_df(spark, events, offset).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        offset += len(events)


def stream(spark, folder):
    schema = spark.read.parquet(f"{folder}/in").schema
    return file_stream(spark, f"{folder}/in", schema, max_files=1)


def ids(df, column="ride_id"):
    return sorted(r[column] for r in df.collect())


def sessions(spark, folder):
    return {r["ride_id"]: r for r in collect(jobs.run_to_table(sessionize(stream(spark, folder)), folder))}


def test_sessionizer_matches_batch_fold(spark, folder):
    rides = [*full_ride("a"), *full_ride("b", 60_000, "d-2"), event("requested", T0, "c"), event("cancelled", T0 + 5, "c"),
             event("requested", T0, "open")]
    feed(spark, folder, [rides[2:4] + rides[6:8], rides[:2] + rides[4:6] + rides[8:]])
    batch = build_sessions(spark.read.parquet(f"{folder}/in"), watermark=F.timestamp_millis(F.lit(T0)))
    assert sessions(spark, folder) == {r["ride_id"]: r for r in collect(batch)}


def test_ride_spans_batches_and_closed_is_final(spark, folder):
    ride = full_ride("a")
    feed(spark, folder, [ride[:2], [ride[2], ride[4]], [ride[3]], [event("cancelled", END + 5, "a")]])
    got = sessions(spark, folder)
    assert got["a"]["event_seq"] == 4 and got["a"]["terminal_state"] == "completed" and got["a"]["started_ts"] is None
    as_of = build_sessions(spark.read.parquet(f"{folder}/in"), as_of_arrival=True)
    assert collect(as_of) == [got["a"]]


@pytest.mark.parametrize("extra,abandoned", [(0, []), (1, ["a"])])
def test_abandoned_strictly_after_the_timeout(spark, folder, extra, abandoned):
    feed(spark, folder, [[event("requested", T0, "a"), event("matched", MATCH, "a")], [event("requested", MATCH + HOURS2 + extra, "b")]])
    got = sessions(spark, folder)
    assert sorted(got) == abandoned
    if abandoned:
        assert got["a"]["terminal_state"] == "abandoned" and got["a"]["ended_ts"] is None and got["a"]["event_seq"] == 2


def test_activity_postpones_the_timeout(spark, folder):
    later = T0 + HOURS2 - 60_000
    feed(spark, folder, [[event("requested", T0, "a")], [event("matched", later, "a")], [event("requested", T0 + HOURS2 + 5, "b")],
                         [event("requested", later + HOURS2 + 1, "c")]])
    got = sessions(spark, folder)
    assert sorted(got) == ["a"]
    assert got["a"]["event_seq"] == 2 and got["a"]["matched_ts"] == later


def test_restart_on_one_checkpoint_emits_once(spark, folder):
    """Rows of open rides that come up to two hours late are kept, across the restart too."""
    feed(spark, folder, [full_ride("a"), full_ride("b")[:3], [event("requested", T0 + HOURS2, "c")]])
    assert sorted(sessions(spark, folder)) == ["a"]
    feed(spark, folder, [full_ride("b")[3:], [event("cancelled", T0 + 5, "c")], full_ride("a")], first_offset=100)
    out = jobs.run_to_table(sessionize(stream(spark, folder)), folder)
    assert {r["ride_id"]: r["event_seq"] for r in out.collect()} == {"a": 5, "b": 5, "c": 2}
    assert out.count() == 3


def test_city_windows_match_batch(spark, folder):
    rides = [*full_ride("a"), *full_ride("b", 30_000), *full_ride("c", 61_000)]
    sentinel = [event("requested", END + 10**6, "z")]
    feed(spark, folder, [rides, sentinel])
    got = jobs.run_to_table(jobs.city_metrics_stream(stream(spark, folder)), folder)
    want = windows.city_metrics(spark.read.parquet(f"{folder}/in").where("ride_id <> 'z'"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ping_sessions_match_batch(spark, folder):
    rows = [("d", T0 + s * 1000, 1, 20.0) for s in (0, 100, 400, 701, 900)] + [("e", T0 + 50_000, 2, 10.0)]
    last = [("z", T0 + 10**7, 1, 1.0)]
    for part in (rows[3:], rows[:3], last):
        df = spark.createDataFrame(part, "driver_id string, ts long, city_id int, speed_kmh double")
        df.withColumn("ts", F.timestamp_millis("ts")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    pings = file_stream(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema)
    got = jobs.run_to_table(jobs.ping_sessions_stream(pings), folder)
    want = shifts.ping_sessions(spark.read.parquet(f"{folder}/in").where("driver_id <> 'z'"), slice_sec=60)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 3


def paid_inputs(spark, folder):
    sessions_df = build_sessions(events_df(spark, [*full_ride("a"), *full_ride("b"), *full_ride("late"), *full_ride("z", 10**8)]))
    sessions_df.write.parquet(f"{folder}/sessions")
    rows = [("t1", "a", END), ("t2", "a", END + 900_000), ("t3", "late", END + 900_001), ("t4", "z", END + 10**8)]
    pay = spark.createDataFrame(rows, "txn_id string, ride_id string, payment_ts long").withColumns(
        {"payment_ts": F.timestamp_millis("payment_ts"), "amount_cents": F.lit(31_400).cast("long"), "status": F.lit("completed"), "method": F.lit("card")}
    )
    pay.write.parquet(f"{folder}/payments")
    return sessions_df, pay, *(file_stream(spark, f"{folder}/{n}", d.schema) for n, d in (("sessions", sessions_df), ("payments", pay)))


def test_payment_joins_match_batch(spark, folder):
    sessions_df, pay, s_stream, p_stream = paid_inputs(spark, folder)
    got = jobs.run_to_table(jobs.ride_payments_stream(s_stream, p_stream), f"{folder}/paid")
    want = joins.ride_payments(with_session_ts(sessions_df), pay)
    assert ids(got, "txn_id") == ids(want, "txn_id") == ["t1", "t2", "t4"]
    unpaid = jobs.run_to_table(jobs.unpaid_rides_stream(s_stream, p_stream), f"{folder}/unpaid")
    assert ids(unpaid) == ids(joins.unpaid_rides(with_session_ts(sessions_df), pay)) == ["b", "late"]


def test_dedup_across_batches(spark, folder):
    ride = full_ride("a")
    feed(spark, folder, [ride, ride[1:3], ride])
    out = jobs.run_to_table(jobs.deduplicated_within_delay(stream(spark, folder)), folder)
    assert ids(out, "event_id") == ids(spark.read.parquet(f"{folder}/in").select("event_id").distinct(), "event_id")


def test_dedup_by_key_loses_no_late_row(spark, folder):
    day = 24 * 3600 * 1000
    feed(spark, folder, [[event("requested", T0 + day, "new")], [event("requested", T0, "old")], [event("requested", T0 + day, "new")]])
    events = stream(spark, folder).withColumn("day", F.to_date("event_ts"))
    table = KeyedTable(spark, f"{folder}/t", events.schema, ["day"], ["event_id"])
    write = jobs.insert_batch(table, [F.col("event_ts")], f"{folder}/cp")
    jobs.start(events, f"{folder}/cp", foreach_batch=write).awaitTermination()
    assert ids(table.read()) == ["new", "old"]


def test_a_new_checkpoint_replaces_and_skips_nothing(spark, folder):
    feed(spark, folder, [full_ride("a")])
    lake = Lake(spark, f"{folder}/lake")
    for n in range(2):
        at = f"{folder}/cp{n}"
        jobs.start(stream(spark, folder), at, foreach_batch=jobs.archive_batch(lake, at)).awaitTermination()
    assert lake.read().count() == 10


def test_late_output_is_row_exact_over_batches_and_replays(spark, folder):
    """The watermark runs along the offsets, within a batch and across; each source partition has its own."""
    at, other = checkpoint(spark, f"{folder}/cp"), checkpoint(spark, f"{folder}/cp2")
    late = jobs.LateOutput(spark, f"{folder}/late", at)
    first = [event("requested", T0 + 600_000, "new"), event("requested", T0, "early"), event("requested", T0, "far", kafka_partition=1)]
    second = [event("requested", T0 + 70_000, "old"), event("matched", T0 + 580_000, "edge"), event("matched", T0 + 570_000, "on"),
              event("matched", T0 + 800_000, "ahead"), event("matched", T0 + 700_000, "behind"), event("matched", T0 + 1, "far", kafka_partition=1)]
    batches = [events_df(spark, first), events_df(spark, second, len(first))]
    late(batches[0], 0)
    late(batches[1], 1)
    late(batches[1], 1)
    wanted = [("behind", 70), ("early", 570), ("old", 500)]
    assert sorted((r["ride_id"], r["late_by_sec"]) for r in late.read().collect()) == wanted
    again = jobs.LateOutput(spark, f"{folder}/late", other)
    again(batches[1], 0)
    found = sorted((r["ride_id"], r["late_by_sec"]) for r in late.read().collect())
    assert found == sorted([*wanted, ("behind", 70)]), "another checkpoint judges by its own batches and replaces nothing"


def wire(spark, values, offset=0):
    rows = [("rides.events", 0, offset + i, b"k", bytearray(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, key binary, value binary")


def test_split_sink_survives_replay_and_loss(spark, folder):
    tables = BatchTables(spark, f"{folder}/t", "g")
    write = jobs.split_batch(tables, checkpoint(spark, f"{folder}/cp"))
    other = jobs.split_batch(tables, checkpoint(spark, f"{folder}/cp2"))
    good = b"\x00" + _body("a")
    write(wire(spark, [good, b"POISON"], 10), 0)
    write(wire(spark, [good, b"POISON"], 10), 0)
    assert tables.read("clean").count() == 1 and tables.read("dead").count() == 1
    assert tables.ledger().first()["kafka_offset"] == 11, "a poison offset counts as consumed"
    # One table of batch 1 is written, then all; the writer is lost before the ledger: neither table shows any of it.
    name = stream_id(spark, f"{folder}/cp")
    for table in ("clean", "dead"):
        tables.read(table).drop("batch").write.parquet(tables.path(table, f"{name}-1"))
        assert tables.read("clean").count() == 1 and tables.read("dead").count() == 1
        assert tables.ledger().first()["kafka_offset"] == 11
    write(wire(spark, [good], 12), 1)
    assert tables.read("clean").count() == 2 and tables.read("dead").count() == 1 and tables.ledger().first()["kafka_offset"] == 12
    other(wire(spark, [good, good], 13), 0)
    assert tables.read("clean").count() == 4 and tables.ledger().first()["kafka_offset"] == 14


def checkpoint(spark, folder):
    """A checkpoint folder with an id, as a query makes it."""
    source = spark.readStream.format("rate").load()
    source.writeStream.format("noop").option("checkpointLocation", folder).trigger(availableNow=True).start().stop()
    return folder


def _body(ride):
    import json

    return json.dumps({k: v for k, v in event("requested", T0, ride).items() if v is not None}).encode()


def wired(spark, events, offset):
    """Wire messages of events, in one partition each, offsets rising."""
    import json

    rows = [
        ("rides.events", e.get("kafka_partition", 0), offset + i, None,
         bytearray(b"\x00" + json.dumps({k: v for k, v in e.items() if v is not None and k != "kafka_partition"}).encode()))
        for i, e in enumerate(events)
    ]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, key binary, value binary")


def feed_of(spark, folder, batches, **options):
    """The feed after some batches, each handed over twice."""
    feed = RideFeed(spark, f"{folder}/feed", checkpoint(spark, f"{folder}/cp"), **options)
    offset = 0
    for number, events in enumerate(batches):
        for _ in range(2):
            feed(wired(spark, events, offset), number)
        offset += len(events)
    return feed


def states(feed):
    return sorted((r["ride_id"], r["terminal_state"], r["event_seq"]) for r in feed.tables.read("sessions").collect())


def test_feed_folds_rides_over_batches(spark, folder):
    """The same sessions as the batch fold; what comes after a ride closed is kept apart."""
    ride, more = full_ride("a"), full_ride("b", 60_000)
    feed = feed_of(spark, folder, [[*ride[1:3], more[0]], [ride[0], ride[4], more[3]], [ride[3], more[1]], more[2:]])
    assert states(feed) == [("a", "completed", 4), ("b", "completed", 5)]
    assert ids(feed.tables.read("ignored"), "event_id") == ["a.4"]
    got = {r["ride_id"]: r for r in collect(feed.tables.read("sessions").drop("batch"))}
    want = {r["ride_id"]: r for r in collect(build_sessions(events_df(spark, [*ride[:3], ride[4], *more])))}
    assert got == want
    assert feed.tables.read("mirror").count() == 11 and feed.tables.ledger().first()["kafka_offset"] == 10


def test_feed_times_out_by_each_partitions_own_watermark(spark, folder):
    """Partitions drift apart by hours: the fast one closes nothing of the slow one, and one without input closes nothing."""
    hours = 3600 * 1000
    slow = [event("requested", T0, "slow", kafka_partition=1), event("matched", T0 + 10, "slow", kafka_partition=1)]
    batches = [
        [event("requested", T0, "fast"), event("requested", T0 + 2 * hours, "exact"), slow[0]],
        [event("requested", T0 + 9 * hours, "later"), event("requested", T0 + 9 * hours, "sad")],
        [slow[1]],
        [event("requested", T0 + 11 * hours + 1, "last"), event("matched", T0, "fast")],
    ]
    feed = feed_of(spark, folder, batches)
    assert states(feed) == [("exact", "abandoned", 1), ("fast", "abandoned", 1), ("later", "abandoned", 1), ("sad", "abandoned", 1)]
    closed_in = {r["ride_id"]: int(r["batch"].rsplit("-", 1)[1]) for r in feed.tables.read("sessions").collect()}
    assert closed_in == {"fast": 1, "exact": 1, "later": 3, "sad": 3}
    newest = feed.tables.last_batch(stream_id(spark, f"{folder}/cp"), 100)
    assert ids(feed.tables.read("open").where(F.col("batch") == newest)) == ["last", "slow"]
    assert ids(feed.tables.read("ignored")) == ["fast"]
    late = sorted((r["ride_id"], r["late_by_sec"]) for r in feed.tables.read("late").collect())
    assert late == [("fast", 11 * 3600 - 30)]


def test_feed_without_clean_messages_and_with_a_short_memory(spark, folder):
    ride = full_ride("a")
    late = event("cancelled", T0 + 8 * 3600 * 1000, "b")
    feed = feed_of(spark, folder, [ride, [event("teleported", T0, "x")], [late], [ride[0]]], remember_sec=3600)
    assert states(feed) == [("a", "abandoned", 1), ("a", "completed", 5), ("b", "cancelled", 1)], "a ride closed long ago is forgotten"
    assert feed.tables.read("letters").count() == 1 and feed.tables.read("ignored").count() == 0
    closed_in = {(r["ride_id"], r["event_seq"]): int(r["batch"].rsplit("-", 1)[1]) for r in feed.tables.read("sessions").collect()}
    assert closed_in == {("a", 5): 0, ("b", 1): 2, ("a", 1): 3}


def test_a_lost_feed_batch_shows_in_no_table(spark, folder):
    ride = full_ride("a")
    feed = feed_of(spark, folder, [ride[:2]])
    stop = RuntimeError("lost")

    def lost(batch, entry):
        raise stop

    commit, feed.tables.commit = feed.tables.commit, lost
    with pytest.raises(RuntimeError, match="lost"):
        feed(wired(spark, ride[2:], 2), 1)
    assert feed.tables.read("mirror").count() == 2 and feed.tables.read("sessions").count() == 0
    assert feed.tables.ledger().first()["kafka_offset"] == 1
    feed.tables.commit = commit
    feed(wired(spark, ride[2:], 2), 1)
    assert states(feed) == [("a", "completed", 5)] and feed.tables.ledger().first()["kafka_offset"] == 4


def test_archive_from_a_stream(spark, folder):
    feed(spark, folder, [full_ride("a"), [event("requested", START, "b", payload_version=2, promo_code="SAVE20")]])
    lake = Lake(spark, f"{folder}/lake")
    source = stream(spark, folder)
    jobs.start(source, f"{folder}/cp", foreach_batch=jobs.archive_batch(lake, f"{folder}/cp")).awaitTermination()
    assert lake.state()[0] == 2 and lake.read().count() == 6
    assert lake.read().where("promo_code = 'SAVE20'").count() == 1


def test_kafka_options_start_early_and_read_committed():
    options = kafka_options("broker:9092", "rides.events", max_offsets=500)
    assert options["startingOffsets"] == "earliest" and options["kafka.isolation.level"] == "read_committed"
    assert options["maxOffsetsPerTrigger"] == "500"


def test_progress_counts_a_repeated_batch_once(spark):
    log = ProgressLog(most=3)
    log.waiting.extend([("q", "r", 0, "2026-01-01T00:00:00.000Z", 9, 1)] * 2)
    log.waiting.extend([("q", "r", 0, "2026-01-01T00:00:01.000Z", 5, 1), ("q", "r", 1, "2026-01-01T00:00:09.000Z", 7, 2)])
    rows = row_counters(log.drained(spark)).select("number", "n_rows", "total").collect()
    assert sorted(map(tuple, rows)) == [(0, 5, 5), (1, 7, 12)]
    assert log.drained(spark).count() == 0, "drained rows wait no more, and old ones make room"
