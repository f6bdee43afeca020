"""Kafka-shaped records to call observations, with bad input set aside."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpulse.functions.envelope import (
    data_envelope,
    key_envelope,
    payload_text,
    plain_key,
    sole_payload,
    walked_envelope,
)
from callpulse.functions.timestamps import parse_timestamp
from callpulse.operators.once import evaluate_once
from callpulse.schema import CALL_FIELDS, TIMESTAMP_FIELDS

# Reasons a record is set aside, in the order they are tested.
BAD_ENVELOPE = "bad_envelope"
FIELD_COUNT = "field_count"
MISSING_PUB_TIME = "missing_pub_time"
BAD_TIMESTAMP = "bad_timestamp"


def decode_records(records: DataFrame) -> DataFrame:
    """Add ``line``, ``tracing`` and ``envelope_ok`` from ``value``; keep the rest."""
    framed = evaluate_once(records, _payload=sole_payload("value"))
    walked = framed.withColumn("_walked", walked_envelope("value", "_payload"))
    decoded = walked.withColumn("_data", data_envelope("value", "_payload", "_walked"))
    return decoded.select(
        *[F.col(name) for name in records.columns],
        payload_text(F.col("_data")).alias("line"),
        F.col("_data.tracing").alias("tracing"),
        F.col("_data.envelope_ok").alias("envelope_ok"),
    )


def decode_keys(records: DataFrame) -> DataFrame:
    """Replace the bytes in ``key`` by a struct ``header, key, envelope_ok``."""
    plain = evaluate_once(records, _plain=plain_key("key"))
    return plain.withColumn("key", key_envelope("key", "_plain")).drop("_plain")


def decode_record_keys(records: DataFrame) -> DataFrame:
    """Replace the bytes in ``key`` by the key text; add tenant and publisher.

    Separate from ``decode_records`` because no figure needs the key.
    """
    identifier = "key.header.identifier"
    return decode_keys(records).select(
        *[
            F.col("key.key" if name == "key" else name).alias(name)
            for name in records.columns
        ],
        F.col(f"{identifier}.tenant").alias("tenant"),
        F.col(f"{identifier}.publisher").alias("publisher"),
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Split ``line`` at commas and bind it, by position, to the call fields.

    Adds the twelve fields and ``reason``, which is null for a good line.
    Commas are never quoted in this feed, so a quoted comma still separates. A
    null line has no fields and is set aside like any other.
    """
    parts = evaluate_once(lines, _parts=F.split("line", ",", -1))

    def text(index: int) -> Column:
        return F.get("_parts", F.lit(index))

    fields = {
        name: parse_timestamp(text(index)) if name in TIMESTAMP_FIELDS else text(index)
        for index, name in enumerate(CALL_FIELDS)
    }
    unreadable = [
        (text(CALL_FIELDS.index(name)) != "") & F.col(name).isNull()
        for name in TIMESTAMP_FIELDS
    ]
    complete = F.coalesce(F.size("_parts"), F.lit(0)) == len(CALL_FIELDS)
    if "envelope_ok" in lines.columns:
        opened = F.coalesce("envelope_ok", F.lit(False))
        reason = F.when(~opened, BAD_ENVELOPE).when(~complete, FIELD_COUNT)
    else:
        reason = F.when(~complete, FIELD_COUNT)
    reason = reason.when(F.coalesce(text(0), F.lit("")) == "", MISSING_PUB_TIME).when(
        reduce(or_, unreadable), BAD_TIMESTAMP
    )
    return (
        evaluate_once(parts, **fields).withColumn("reason", reason).drop("_parts")
    )


def observations(parsed: DataFrame, *keep: str) -> DataFrame:
    """The good lines as call observations, with any columns named in ``keep``."""
    return parsed.where(F.col("reason").isNull()).select(*keep, *CALL_FIELDS)


def quarantined(parsed: DataFrame) -> DataFrame:
    """The lines set aside, each with its reason and without parsed fields.

    Every other column stays: of records that is the undecoded key and value and
    where they were read from, so that they can be inspected and sent again.
    """
    return parsed.where(F.col("reason").isNotNull()).drop(
        *CALL_FIELDS, "tracing", "envelope_ok"
    )


def call_observations(records: DataFrame) -> DataFrame:
    """Good call observations of enveloped records."""
    return observations(parse_lines(decode_records(records).select("line", "envelope_ok")))
