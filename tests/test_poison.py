from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators import poison
from fareflow.schemas import ENVELOPE, LANDED_EVENT_COLUMNS, WIRE_MESSAGE
from tests.rides import T0, collect, event

NOW = 1_767_225_600_000


def body(**changes) -> bytes:
    record = {k: v for k, v in event("requested", T0).items() if v is not None}
    record.update(changes)
    return json.dumps({k: v for k, v in record.items() if v != "drop"}).encode()


def messages(spark, values, key=b"r-1"):
    rows = [("rides.events", 0, i, key, bytearray(v) if v is not None else None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, WIRE_MESSAGE)


def errors(spark, values):
    decoded = poison.decode_ride_events(messages(spark, values))
    return [r["error"] for r in decoded.orderBy("offset").collect()]


def dead(spark, values, key=b"r-1"):
    decoded = poison.decode_ride_events(messages(spark, values, key))
    return poison.envelopes(decoded, "sink", F.timestamp_millis(F.lit(NOW)))


def test_frame_body_and_type_faults(spark):
    good = body()
    assert errors(
        spark,
        [b"\x00" + good, b"\xff" + good, b"POISON", b"\x00" + good[:-4], b"\x00" + body(ride_id="drop"),
         b"\x00" + body(event_type="teleported"), b"\x00" + body(city_id="x"), b"", None],
    ) == [None, "bad frame byte", "bad frame byte", "undecodable body", "undecodable body",
          "unknown event type", "undecodable body", "bad frame byte", "empty message"]


def test_versions_read_alike(spark):
    v1 = body(payload_version="drop")
    v2 = body(payload_version=2, promo_code="SAVE10", note="an unknown field is ignored")
    clean = poison.clean_rows(poison.decode_ride_events(messages(spark, [b"\x00" + v1, b"\x00" + v2])))
    rows = sorted(collect(clean), key=lambda r: r["kafka_offset"])
    assert [(r["payload_version"], r["promo_code"], r["event_ts"]) for r in rows] == [(1, None, T0), (2, "SAVE10", T0)]


def test_landing_columns(spark):
    clean = poison.clean_rows(poison.decode_ride_events(messages(spark, [b"\x00" + body()])))
    landed = poison.landing_rows(clean, F.current_timestamp())
    assert tuple(landed.columns) == LANDED_EVENT_COLUMNS
    assert landed.first()["event_seq"] == 1


def test_envelope_keeps_bytes_and_null_key(spark):
    raw = bytes(range(256)) * 3
    rows = dead(spark, [b"\xff" + raw], key=None)
    texts = poison.envelope_json(rows)
    assert json.loads(texts.first()["value"])["key_b64"] is None
    back = poison.parse_envelopes(texts)
    assert back.columns == ENVELOPE.names
    assert back.collect() == rows.collect()
    row = back.select(F.unbase64("payload_b64").alias("p"), "failed_at", "key_b64").first()
    assert bytes(row["p"]) == b"\xff" + raw and row["key_b64"] is None
    assert row["failed_at"] == "2026-01-01T00:00:00.000+00:00"


def test_replay_repairs_and_counts(spark):
    good = body()
    rows = dead(spark, [b"\xff" + good, b"POISON", b"\xff" + good])
    done = poison.replay(rows, "offset <> 2", poison.repair_frame)
    assert done.stats.first().asDict() == {"seen": 3, "filtered_out": 1, "replayed": 2, "dry_run": False}
    again = done.messages.select("topic", F.lit(0).alias("partition"), F.lit(0).alias("offset"), "key", "value")
    found = [r["error"] for r in poison.decode_ride_events(again).collect()]
    assert sorted(found, key=str) == [None, "undecodable body"]
    assert {bytes(r["key"]) for r in done.messages.collect()} == {b"r-1"}


def test_dry_run_sends_nothing(spark):
    done = poison.replay(dead(spark, [b"x", b"y"]), dry_run=True)
    assert done.stats.first().asDict() == {"seen": 2, "filtered_out": 0, "replayed": 2, "dry_run": True}
    assert done.messages.count() == 0


def test_unknown_predicate_result_filters_out(spark):
    done = poison.replay(dead(spark, [b"x"], key=None), "key_b64 = 'a'")
    assert done.stats.first()["filtered_out"] == 1


def test_custom_transform_and_empty_payload(spark):
    rows = dead(spark, [b"abc", b""])
    sent = poison.replay(rows, transform=poison.bytes_transform(lambda b: b[::-1])).messages
    assert sorted(bytes(r["value"]) for r in sent.collect()) == [b"", b"cba"]
    kept = poison.replay(rows, transform=poison.repair_frame).messages
    assert sorted(bytes(r["value"]) for r in kept.collect()) == [b"", b"\x00bc"]


PAYMENT = {"txn_id": "t", "ride_id": "r", "amount_cents": 5, "status": "completed", "method": "card", "ts": NOW}


@pytest.mark.parametrize(
    "text,error",
    [
        (json.dumps(PAYMENT), None),
        (json.dumps({**PAYMENT, "amount_cents": 0}), None),
        (json.dumps({**PAYMENT, "amount_cents": 12.0}), None),
        ("{", "not a JSON object"),
        ("[1]", "not a JSON object"),
        ("3", "not a JSON object"),
        (None, "not a JSON object"),
        (json.dumps({k: v for k, v in PAYMENT.items() if k != "ts"}), "missing key"),
        (json.dumps({**PAYMENT, "note": 1}), "extra key"),
        (json.dumps({**PAYMENT, "amount_cents": "5"}), "wrong type"),
        (json.dumps({**PAYMENT, "amount_cents": 5.5}), "wrong type"),
        (json.dumps({**PAYMENT, "amount_cents": True}), "wrong type"),
        (json.dumps({**PAYMENT, "txn_id": 7}), "wrong type"),
        (json.dumps({**PAYMENT, "ts": None}), "wrong type"),
        (json.dumps({**PAYMENT, "amount_cents": -1}), "negative amount"),
        (json.dumps({**PAYMENT, "status": "captured"}), "value not allowed"),
        (json.dumps({**PAYMENT, "method": None}), "value not allowed"),
    ],
)
def test_payment_contract(spark, text, error):
    schema = T.StructType([T.StructField("value", T.StringType())])
    decoded = poison.decode_payments(spark.createDataFrame([(text,)], schema))
    assert decoded.first()["error"] == error
    assert poison.clean_payments(decoded).count() == (error is None)
