"""Topic readers: Kafka or files of the same envelope, typed JSON parsing, validation and quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType

from kerbside.schemas import (
    ALERTS_TOPIC, COORDINATES, GPS_TOPIC, MESSAGES, POINT, SPELLINGS, WATERMARKS,
)

ENVELOPE = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
CORRUPT = "_corrupt"


def read_topics(spark: SparkSession, topics: str | Sequence[str], *, bootstrap: str | None = None,
                path: str | None = None, streaming: bool = True, starting: str = "earliest",
                **options: str) -> DataFrame:
    """Raw messages of one or several topics, each tagged with its topic.

    With ``bootstrap`` from Kafka (needs the Kafka connector on the class path), with ``path`` from Parquet files that
    hold the same envelope. Batch reads of files prune by topic when the folder is partitioned by it. Expired offsets end
    the query, as is Kafka's default; ``failOnDataLoss="false"`` among the options skips them.
    """
    topics = [topics] if isinstance(topics, str) else list(topics)
    reader = spark.readStream if streaming else spark.read
    if bootstrap:
        return (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting)
            .options(**options)
            .load()
        )
    if not path:
        raise ValueError("give bootstrap or path")
    return reader.schema(ENVELOPE).options(**options).parquet(path).where(F.col("topic").isin(topics))


def superset(topics: Sequence[str]) -> StructType:
    """All fields of the topics' messages; a field several topics share appears once."""
    fields = {f.name: f for t in topics for f in MESSAGES[t].fields}
    return StructType(list(fields.values()))


def _wire_schema(fields: StructType) -> StructType:
    """What ``from_json`` reads: every spelling, and the location as text because it comes in two shapes."""
    wire = []
    for field in fields.fields:
        kind = StringType() if field.name == "location" else field.dataType
        wire += [StructField(name, kind, True) for name in SPELLINGS.get(field.name, [field.name])]
    return StructType([*wire, StructField(CORRUPT, StringType(), True)])


def _distinct_names(wire: StructType) -> StructType:
    """The same fields under names that differ in more than case: JSON keys are matched by case, columns are not."""
    seen, fields = set(), []
    for field in wire.fields:
        name = field.name
        while name.lower() in seen:
            name += "_"
        seen.add(name.lower())
        fields.append(StructField(name, field.dataType, True))
    return StructType(fields)


def _spelled(name: str, wire: StructType, renamed: StructType) -> Column:
    names = SPELLINGS.get(name)
    if not names:
        return F.col(name)
    read_as = dict(zip(wire.names, renamed.names))
    return F.coalesce(*[F.nullif(F.col(read_as[n]), F.lit("")) for n in names])


def _location(kind: DataType) -> Column:
    """Location text in the shape wanted; one parse when it was sent in that shape, else converted."""
    text = F.col("location")
    as_list, point = F.from_json(text, COORDINATES), F.from_json(text, POINT)
    sent_as_list = F.ltrim(text).startswith("[")
    if kind == COORDINATES:
        return F.when(sent_as_list, as_list).when(point["latitude"].isNotNull(), F.array(point["latitude"], point["longitude"]))
    converted = F.struct(F.get(as_list, F.lit(0)).alias("latitude"), F.get(as_list, F.lit(1)).alias("longitude"))
    return F.when(sent_as_list, converted).otherwise(point)


def parse_messages(envelope: DataFrame, fields: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from the JSON value, plus ``event_time`` and, for text that is no such JSON, ``_corrupt``.

    The parsed struct goes through ``inline``: as a plain column, every filter on a field would be pushed down with its own
    copy of ``from_json``, and each message would be parsed once per filter.
    """
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    wire = _wire_schema(fields)
    renamed = _distinct_names(wire)
    text = F.col("value").cast("string")
    parsed = envelope.select(
        *[F.col(c).alias(f"_kept_{c}") for c in keep], F.inline(F.array(F.from_json(text, wire, options).cast(renamed)))
    )
    columns = []
    for field in fields.fields:
        if field.name == "location":
            columns.append(_location(field.dataType).alias("location"))
        else:
            columns.append(_spelled(field.name, wire, renamed).alias(field.name))
    names = {f.name for f in fields.fields}
    if "timestamp" in names:
        event_time = F.try_to_timestamp(F.col("timestamp"))
    else:
        event_time = F.timestamp_millis("ts") if "ts" in names else F.lit(None).cast("timestamp")
    return parsed.select(
        *[F.col(f"_kept_{c}").alias(c) for c in keep], *columns, event_time.alias("event_time"), F.col(CORRUPT)
    )


def good(parsed: DataFrame, need_device: bool = True) -> DataFrame:
    """Messages that parsed and name a device."""
    kept = parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return kept.where(F.col("deviceId").isNotNull()) if need_device else kept


def quarantine(parsed: DataFrame) -> DataFrame:
    """Messages that did not parse: the text and why."""
    return parsed.where(F.col(CORRUPT).isNotNull()).withColumn("reject_reason", F.lit("malformed"))


def topic_rows(envelope: DataFrame, topic: str) -> DataFrame:
    """Clean typed rows of one topic, without a watermark."""
    return good(parse_messages(envelope.where(F.col("topic") == topic), MESSAGES[topic]))


def topic_stream(envelope: DataFrame, topic: str) -> DataFrame:
    """Clean typed rows of one topic; a streaming input also gets the topic's watermark."""
    rows = topic_rows(envelope, topic)
    if rows.isStreaming and topic in WATERMARKS:
        rows = rows.withWatermark("event_time", WATERMARKS[topic])
    return rows


def multi_topic_stream(envelope: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Clean rows of several topics in one frame: the source is read and parsed once, absent fields are null."""
    rows = envelope.where(F.col("topic").isin(list(topics)))
    return good(parse_messages(rows, superset(topics), keep=["topic"]))


def speed_limit_stream(envelope: DataFrame, topic: str) -> DataFrame:
    """Speed-limit records under the names the join uses."""
    rows = topic_stream(envelope, topic)
    return rows.select(
        F.col("deviceId").alias("deviceId_sl"),
        "placeId",
        "SpeedLimit",
        F.col("timestamp").alias("Timestamp"),
        F.col("event_time").alias("event_time_speed"),
    )


def alert_stream(envelope: DataFrame) -> DataFrame:
    """Driver alerts with their event time (epoch milliseconds)."""
    return topic_stream(envelope, ALERTS_TOPIC)


def validate_gps(envelope: DataFrame) -> DataFrame:
    """GPS messages with defaults filled in and ``reject_reason`` where a required field is missing or of a wrong type.

    A missing id becomes the MD5 of the message, so that a task that runs again gives the same id. Speeds sent as
    numeric text are accepted.
    """
    text_speed = StructType([
        StructField("speed", StringType(), True) if f.name == "speed" else f for f in MESSAGES[GPS_TOPIC].fields
    ])
    rows = parse_messages(envelope.where(F.col("topic") == GPS_TOPIC), text_speed, keep=["value"])
    speed = F.col("speed").try_cast(DoubleType())
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(F.col("deviceId").isNull(), "deviceId")
        .when(F.col("event_time").isNull(), "timestamp")
        .when(speed.isNull(), "speed")
        .when(F.col("direction").isNull(), "direction")
        .when(F.col("location").isNull() | F.exists("location", lambda x: x.isNull()), "location")
    )
    return rows.select(
        F.coalesce("id", F.md5("value")).alias("id"),
        "deviceId", "event_time", speed.alias("speed"), "direction",
        F.coalesce("vehicle_type", F.lit("private")).alias("vehicle_type"),
        "location", "SpeedLimit", reason.alias("reject_reason"),
        F.col("value").cast("string").alias("message"),
    )


def valid_gps(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject_reason").isNull()).drop("reject_reason", "message")


def rejected_gps(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject_reason").isNotNull()).select("message", "reject_reason")


def has_two_coordinates(location: Column) -> Column:
    return F.coalesce(F.size(location) == 2, F.lit(False))
