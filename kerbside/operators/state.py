"""Last known state of a device across topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.operators.timeline import Timeline, union_all

#: Fields the advice needs.
STATE_TYPES = {
    "make": "string", "model": "string", "year": "int", "auto_braking_supported": "boolean", "abs_supported": "boolean",
    "traction_control_supported": "boolean", "speed": "double", "SpeedLimit": "double", "weatherCondition": "string",
    "type": "string", "status": "string",
}
STATE_FIELDS = list(STATE_TYPES)


def tagged(topic: str, rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The part of a topic's rows the state needs."""
    return rows.select("id", "deviceId", "event_time", F.lit(topic).alias("topic"), *fields)


def device_state(topics: Sequence[DataFrame], fields: Sequence[str] = STATE_FIELDS,
                 rows_per_slice: int | None = None) -> DataFrame:
    """Every message with the device's state after it: per field the latest value any topic has sent.

    One union and one window for all fields and topics: a single shuffle, however many topics take part.
    """
    rows = union_all(topics)
    present = [f for f in fields if f in rows.columns]
    line = Timeline(rows, ["deviceId"], F.unix_micros("event_time"), ["id", "topic"], rows_per_slice)
    return line.last_known(**{f: F.col(f) for f in present}).done()


def latest_state(rows: DataFrame, fields: Sequence[str] = STATE_FIELDS) -> DataFrame:
    """One row per device: the latest value of each field. Combines before the shuffle; runs on streams too."""
    order = F.struct("event_time", "id")
    present = [f for f in fields if f in rows.columns]
    return rows.groupBy("deviceId").agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), order)).alias(f) for f in present],
        F.count(F.lit(1)).alias("messages"),
    )


def has_active_incident(kind: Column, status: Column) -> Column:
    return F.coalesce((status == "Active") & (kind != "None"), F.lit(False))
