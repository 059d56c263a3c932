"""Decode wire messages, split off poison, build and replay dead letters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.functions.rides import event_ordinal
from fareflow.functions.times import from_epoch_ms, iso_utc
from fareflow.schemas import (
    ENVELOPE,
    FRAME_OK,
    LANDED_EVENT_COLUMNS,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    RIDE_EVENT,
)

BODY_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.LongType() if f.name == "event_ts" else f.dataType)
        for f in RIDE_EVENT.fields
    ]
)


def parsed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add an expensive column behind a generator.

    Filters on what is derived from it stay above, instead of being pushed below with a copy of
    the expression for every reference.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def frame_byte() -> Column:
    return F.lit(bytes([FRAME_OK]))


def decode_ride_events(
    messages: DataFrame, avro_schema: str | None = None, header_bytes: int = 1
) -> DataFrame:
    """Add ``record`` (a v2 ride event, null for poison) and ``error`` (null for clean rows).

    The first byte must be the frame byte. The body is JSON, or Avro when a schema is given
    (needs the spark-avro package and its header length). v1 bodies decode with a null
    ``promo_code`` and ``payload_version`` 1 where it is missing. No message fails the job.
    """
    framed = F.substring("value", 1, 1) == frame_byte()
    body = F.expr(f"substring(value, {header_bytes + 1})")
    if avro_schema is None:
        parsed = F.from_json(body.cast("string"), BODY_SCHEMA, {"mode": "PERMISSIVE"})
    else:
        from pyspark.sql.avro.functions import from_avro

        parsed = from_avro(body, avro_schema, {"mode": "PERMISSIVE"})
    required = [f.name for f in RIDE_EVENT.fields if not f.nullable and f.name != "payload_version"]
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(f"_parsed.{name}").isNull()
    rows = parsed_once(messages, "_parsed", F.when(framed, parsed))
    error = (
        F.when(F.col("value").isNull(), "empty message")
        .when(~framed, "bad frame byte")
        .when(F.col("_parsed").isNull() | missing, "undecodable body")
        .when(event_ordinal(F.col("_parsed.event_type")).isNull(), "unknown event type")
    )
    record = F.struct(
        *[
            (
                from_epoch_ms(F.col("_parsed.event_ts"))
                if name == "event_ts" and avro_schema is None
                else F.coalesce(F.col("_parsed.payload_version"), F.lit(1))
                if name == "payload_version"
                else F.col(f"_parsed.{name}")
            ).alias(name)
            for name in RIDE_EVENT.names
        ]
    )
    return (
        rows.withColumn("error", error)
        .withColumn("record", F.when(F.col("error").isNull(), record))
        .drop("_parsed")
    )


def clean_rows(decoded: DataFrame) -> DataFrame:
    """Decoded records in arrival form: late, out-of-order and repeated rows all stay."""
    return decoded.where(F.col("error").isNull()).select(
        "record.*", F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset")
    )


def landing_rows(clean: DataFrame, ingested_at: Column) -> DataFrame:
    """Clean ride events in the column set of the landing table."""
    return clean.withColumns(
        {"event_seq": event_ordinal(F.col("event_type")), "ingested_at": ingested_at}
    ).select(*LANDED_EVENT_COLUMNS)


def envelopes(decoded: DataFrame, consumer_group: str, failed_at: Column) -> DataFrame:
    """Dead-letter rows of the poison messages, with their bytes kept exactly."""
    return decoded.where(F.col("error").isNotNull()).select(
        F.col("topic").alias("source_topic"),
        "partition",
        "offset",
        F.base64("key").alias("key_b64"),
        F.base64(F.coalesce("value", F.lit(b""))).alias("payload_b64"),
        "error",
        F.lit(consumer_group).alias("consumer_group"),
        iso_utc(failed_at).alias("failed_at"),
    )


def envelope_json(rows: DataFrame) -> DataFrame:
    """Envelopes as JSON text for a dead-letter topic; a null key stays in the text."""
    body = F.to_json(F.struct(*ENVELOPE.names), {"ignoreNullFields": "false"})
    return rows.select(F.unbase64("key_b64").alias("key"), body.alias("value"))


def parse_envelopes(texts: DataFrame, column: str = "value") -> DataFrame:
    return texts.select(F.from_json(F.col(column).cast("string"), ENVELOPE).alias("e")).select("e.*")


def repair_frame(payload: Column) -> Column:
    """Put the frame byte back in first place; an empty payload stays empty."""
    return F.when(F.length(payload) > 0, F.concat(frame_byte(), F.substring(payload, 2, 2**31 - 1))).otherwise(payload)


def bytes_transform(fn: Callable[[bytes], bytes]) -> Callable[[Column], Column]:
    """Lift a bytes-to-bytes function to a Column function (Arrow batches)."""

    @F.pandas_udf(T.BinaryType())
    def apply(payloads: pd.Series) -> pd.Series:
        return payloads.map(fn)

    return apply


@dataclass(frozen=True)
class Replay:
    """Messages to send again (none in a dry run) and a one-row summary."""

    messages: DataFrame
    stats: DataFrame


def replay(
    dead: DataFrame,
    predicate: str | None = None,
    transform: Callable[[Column], Column] | None = None,
    dry_run: bool = False,
) -> Replay:
    """Select dead letters with a SQL predicate over the envelope, repair, and re-address them."""
    keep = F.coalesce(F.expr(predicate), F.lit(False)) if predicate else F.lit(True)
    stats = dead.agg(
        F.count(F.lit(1)).alias("seen"),
        F.count_if(~keep).alias("filtered_out"),
        F.count_if(keep).alias("replayed"),
        F.lit(dry_run).alias("dry_run"),
    )
    payload = F.unbase64("payload_b64")
    messages = dead.where(keep).select(
        F.col("source_topic").alias("topic"),
        F.unbase64("key_b64").alias("key"),
        (transform(payload) if transform else payload).alias("value"),
    )
    return Replay(messages.limit(0) if dry_run else messages, stats)


# --- payments ----------------------------------------------------------------------------

_PAYMENT_KEYS = ("txn_id", "ride_id", "amount_cents", "status", "method", "ts")


def decode_payments(messages: DataFrame, column: str = "value") -> DataFrame:
    """Add the payment fields and ``error`` (null when the text obeys the payment contract).

    Contract: a JSON object with exactly the six keys, string ids, whole-number amount and time,
    a non-negative amount, and status and method from their sets.
    """
    v = F.try_parse_json(F.col(column).cast("string"))

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", kind)

    def kind_of(name: str) -> Column:
        return F.coalesce(F.schema_of_variant(F.variant_get("_v", f"$.{name}", "variant")), F.lit("MISSING"))

    def whole(name: str) -> Column:
        number = F.try_variant_get("_v", f"$.{name}", "double")
        is_number = F.regexp_like(kind_of(name), F.lit("^(BIGINT|DECIMAL|DOUBLE)"))
        return is_number & F.coalesce(number == F.floor(number), F.lit(False))

    rows = parsed_once(
        messages,
        "_p",
        F.struct(v.alias("v"), F.json_object_keys(F.col(column).cast("string")).alias("keys")),
    ).withColumns({"_v": F.col("_p.v"), "_keys": F.col("_p.keys")})
    is_object = F.coalesce(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT")), F.lit(False))
    error = (
        F.when(F.col("_v").isNull() | ~is_object, "not a JSON object")
        .when(
            F.size(F.array_except(F.array(*map(F.lit, _PAYMENT_KEYS)), "_keys")) > 0, "missing key"
        )
        .when(F.size(F.array_except("_keys", F.array(*map(F.lit, _PAYMENT_KEYS)))) > 0, "extra key")
        .when(
            (kind_of("txn_id") != "STRING")
            | (kind_of("ride_id") != "STRING")
            | ~whole("amount_cents")
            | ~whole("ts"),
            "wrong type",
        )
        .when(field("amount_cents", "bigint") < 0, "negative amount")
        .when(
            ~F.coalesce(field("status", "string").isin(*PAYMENT_STATUSES), F.lit(False))
            | ~F.coalesce(field("method", "string").isin(*PAYMENT_METHODS), F.lit(False)),
            "value not allowed",
        )
    )
    return (
        rows.withColumn("error", error)
        .withColumns(
            {
                "txn_id": field("txn_id", "string"),
                "ride_id": field("ride_id", "string"),
                "amount_cents": field("amount_cents", "bigint"),
                "status": field("status", "string"),
                "method": field("method", "string"),
                "payment_ts": from_epoch_ms(field("ts", "bigint")),
            }
        )
        .drop("_p", "_v", "_keys")
    )


PAYMENT_COLUMNS = ("txn_id", "ride_id", "amount_cents", "status", "method", "payment_ts")


def clean_payments(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("error").isNull()).select(*PAYMENT_COLUMNS)


def parseable_payments(messages: DataFrame, column: str = "value") -> DataFrame:
    """Payments that parse as JSON objects; unreadable text is skipped, a bad number is null."""
    v = F.try_parse_json(F.col(column).cast("string"))
    rows = parsed_once(messages, "_v", v).where(
        F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT"))
    )

    def whole(name: str) -> Column:
        exact = F.try_variant_get("_v", f"$.{name}", "double")
        return F.when(exact == F.floor(exact), F.try_variant_get("_v", f"$.{name}", "bigint"))

    def text(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "string").alias(name)

    return rows.select(
        text("txn_id"),
        text("ride_id"),
        whole("amount_cents").alias("amount_cents"),
        text("status"),
        text("method"),
        from_epoch_ms(whole("ts")).alias("payment_ts"),
    )
