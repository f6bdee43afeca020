"""Keyed text as enveloped Kafka records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callpulse.functions.envelope import (
    encode_data,
    flag_field,
    length_delimited,
    text_field,
)
from callpulse.operators.once import evaluate_once


def envelope(
    keyed: DataFrame,
    tenant: Column,
    publisher: Column,
    retained: Column | None = None,
    qos: Column | None = None,
) -> DataFrame:
    """Encode the text columns ``key`` and ``value``; keep every other column.

    ``retained`` defaults to false and ``qos`` to BEST_EFFORT.
    """
    named = keyed.withColumns(
        {
            "_key": F.coalesce("key", F.lit("")),
            "_tenant": F.coalesce(tenant, F.lit("")),
            "_publisher": F.coalesce(publisher, F.lit("")),
            "_retained": F.lit(False) if retained is None else retained,
            "_reliable": F.lit(False) if qos is None else qos == "RELIABLE",
        }
    )
    identity = f"concat({text_field(1, '_tenant')}, {text_field(2, '_publisher')})"
    identified = evaluate_once(named, _identity=F.expr(identity))
    header = ", ".join(
        [
            length_delimited(1, "_identity"),
            flag_field(2, "_retained"),
            flag_field(3, "_reliable"),
        ]
    )
    headed = evaluate_once(identified, _header=F.expr(f"concat({header})"))
    encoded = evaluate_once(
        headed,
        _encoded_key=F.expr(
            f"concat({length_delimited(1, '_header')}, {text_field(2, '_key')})"
        ),
        _encoded_value=encode_data("value"),
    )
    encoded_as = {"key": "_encoded_key", "value": "_encoded_value"}
    return encoded.select(
        *[F.col(encoded_as.get(name, name)).alias(name) for name in keyed.columns]
    )


def frames(
    messages: DataFrame, tenant: str, publishers: Mapping[str, str] | None = None
) -> DataFrame:
    """Messages as binary ``key`` and ``value`` ready for the Kafka sink.

    A figure is published under its own name unless ``publishers`` maps its
    message key to another.
    """
    publisher = F.col("key")
    for key, name in (publishers or {}).items():
        publisher = F.when(F.col("key") == key, F.lit(name)).otherwise(publisher)
    return envelope(messages.select("key", "value"), F.lit(tenant), publisher)
