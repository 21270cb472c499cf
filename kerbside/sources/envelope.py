"""Rows -> topic messages: JSON value, device key, Kafka-shaped columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_time(at: Column) -> Column:
    """Naive UTC ISO text, as the producers write it."""
    return F.date_format(at, ISO_MICROS)


def to_messages(rows: DataFrame, key: str | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """``key`` and JSON ``value`` of each row; without a key column the message is keyless."""
    value = F.to_json(F.struct(*(fields or rows.columns))).alias("value")
    return rows.select(F.col(key).cast("string").alias("key"), value) if key else rows.select(value)


def to_envelope(rows: DataFrame, topic: str, key: str, at: str, fields: Sequence[str], offset: str | None = None,
                value: Column | None = None) -> DataFrame:
    """What a Kafka read of these rows would give; for file replays."""
    text = value if value is not None else F.to_json(F.struct(*fields))
    return rows.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        (F.col(offset).cast("bigint") if offset else F.lit(0).cast("bigint")).alias("offset"),
        F.col(at).alias("timestamp"),
    )
