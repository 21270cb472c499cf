"""The vehicle topics, derived from the star-schema test tables (``events`` and ``part``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kerbside import schemas as s
from kerbside.sources.envelope import iso_time, to_envelope

GPS_TYPES = ["click", "view", "signup"]
LAT_STEP = 0.009788
LNG_STEP = 0.017626


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(options: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(o) for o in options]), index.cast("int"))


def _events(spark: SparkSession, sf_dir: str, types: list[str] | None = None) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.where(F.col("event_type").isin(types)) if types else rows


def _who_and_when() -> list[Column]:
    return [
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("deviceId"),
        F.col("ts").cast("timestamp").alias("event_time"),
    ]


def position(step: Column) -> tuple[Column, Column]:
    """A place on the sample journey; ``step`` counts hundredths of the way."""
    return F.lit(s.JOURNEY_START[0]) + F.lit(LAT_STEP) * step, F.lit(s.JOURNEY_START[1]) - F.lit(LNG_STEP) * step


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lng = position(F.col("event_id") % 100)
    return _events(spark, sf_dir, GPS_TYPES).select(
        *_who_and_when(), F.col("value").alias("speed"), F.lit("North-East").alias("direction"),
        F.lit("private").alias("vehicle_type"), F.array(lat, lng).alias("location"),
    )


def limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, ["purchase"]).select(
        *_who_and_when(),
        (F.col("event_id") % 97).cast("string").alias("placeId"),
        _pick([float(v) for v in s.POSTED_LIMITS], F.col("event_id") % 8).alias("SpeedLimit"),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, ["error"]).select(
        *_who_and_when(),
        _pick(["slow_down", "maintain_speed", "speed_up"], _k() % 3).alias("action"),
        F.floor("value").cast("double").alias("target_speed"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("reason"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lng = position(F.col("event_id") % 100)
    code = _pick(list(s.WEATHER_LABELS), F.col("event_id") % 18)
    label = _pick(list(s.WEATHER_LABELS.values()), F.col("event_id") % 18)
    return _events(spark, sf_dir, ["signup"]).select(
        *_who_and_when(), code.alias("weather_code"), label.alias("weatherCondition"),
        (F.col("event_id") % 32 - 5).cast("double").alias("temperature"),
        (F.col("event_id") % 100).cast("double").alias("windSpeed"),
        lat.alias("latitude"), lng.alias("longitude"),
    )


def emergency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, ["error"]).select(
        *_who_and_when(), F.concat(F.lit("I"), F.col("event_id").cast("string")).alias("incidentId"),
        _pick(["Accident", "Fire", "Police", "None"], F.col("event_id") % 4).alias("type"),
        _pick(["Active", "Resolved"], F.col("event_id") % 2).alias("status"),
        F.lit("Description of the incident").alias("description"),
    )


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir, ["view"]).select(
        *_who_and_when(), F.concat(F.lit("Camera"), _k().cast("string")).alias("cameraID"),
        F.lit("Base64EncodedString").alias("snapshot"),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One capability record per device, sent with its first event."""
    rows = _events(spark, sf_dir).groupBy("user_id").agg(F.min("event_id").alias("event_id"), F.min("ts").alias("ts"))
    row = F.col("user_id") % 4
    columns = ["make", "model", "year", "auto_braking_supported", "abs_supported", "traction_control_supported"]
    return rows.select(
        *_who_and_when(), F.lit("Hybrid").alias("fuelType"),
        *[_pick([c[i] for c in s.CAPABILITIES], row).alias(name) for i, name in enumerate(columns)],
    )


def road_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    lat, lng = position(key % 100)
    shift = F.lit(0.0005) * (F.floor(key / 100) % 3 - 1)
    return table(spark, sf_dir, "part").select(
        key.cast("bigint").alias("placeId"), (lat + shift).alias("latitude"), lng.alias("longitude")
    )


def parallel_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The road points as three roads side by side, with how far along its road each lies."""
    roads = road_points(spark, sf_dir)
    return roads.withColumns({"roadId": F.floor(F.col("placeId") / 100) % 3, "along_m": (F.col("placeId") % 100) * F.lit(1635.0)})


def shaken(gps: DataFrame) -> DataFrame:
    """Fixes up to 33 metres off their place, to the one side or the other."""
    place = F.col("location")
    off = F.lit(0.0003) * (F.floor(F.col("id") / 7) % 3 - 1)
    return gps.withColumn("location", F.array(F.get(place, F.lit(0)) + off, F.get(place, F.lit(1))))


def _message_rows(rows: DataFrame, **extra: Column) -> DataFrame:
    return rows.withColumn("timestamp", iso_time(F.col("event_time"))).withColumn("id", F.col("id").cast("string")) \
        .withColumns(extra)


def gps_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _message_rows(gps(spark, sf_dir))
    fields = ["id", "deviceId", "timestamp", "speed", "direction", "vehicle_type", "location"]
    return to_envelope(rows, s.GPS_TOPIC, "id", "event_time", fields, "id")


def limit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the records spell the device field one way, half the other."""
    rows = _message_rows(limits(spark, sf_dir))
    even = F.col("id").cast("bigint") % 2 == 0
    upper = F.to_json(F.struct(F.col("deviceId").alias("deviceID"), "placeId", "timestamp", "SpeedLimit"))
    lower = F.to_json(F.struct("deviceId", "placeId", "timestamp", "SpeedLimit"))
    return to_envelope(rows, s.ROUTES_TOPIC, "deviceId", "event_time", [], "id", value=F.when(even, upper).otherwise(lower))


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["deviceId", "action", "target_speed", "reason", "ts"]
    return to_envelope(alerts(spark, sf_dir), s.ALERTS_TOPIC, "deviceId", "event_time", fields, "id")


def _located(rows: DataFrame) -> DataFrame:
    lat, lng = position(F.col("id").cast("bigint") % 100)
    return _message_rows(rows, location=F.struct(lat.alias("latitude"), lng.alias("longitude")))


def vehicle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _located(vehicles(spark, sf_dir))
    fields = ["id", "deviceId", "timestamp", "location", "make", "model", "year", "fuelType",
              "auto_braking_supported", "abs_supported", "traction_control_supported"]
    return to_envelope(rows, s.VEHICLE_TOPIC, "id", "event_time", fields, "id")


def traffic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["id", "deviceId", "cameraID", "location", "timestamp", "snapshot"]
    return to_envelope(_located(traffic(spark, sf_dir)), s.TRAFFIC_TOPIC, "id", "event_time", fields, "id")


def weather_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["id", "deviceId", "location", "timestamp", "temperature", "weatherCondition", "windSpeed"]
    return to_envelope(_located(weather(spark, sf_dir)), s.WEATHER_TOPIC, "id", "event_time", fields, "id")


def emergency_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["id", "deviceId", "incidentId", "type", "timestamp", "location", "status", "description"]
    return to_envelope(_located(emergency(spark, sf_dir)), s.EMERGENCY_TOPIC, "id", "event_time", fields, "id")


MESSAGES = {
    s.VEHICLE_TOPIC: vehicle_messages,
    s.GPS_TOPIC: gps_messages,
    s.TRAFFIC_TOPIC: traffic_messages,
    s.WEATHER_TOPIC: weather_messages,
    s.EMERGENCY_TOPIC: emergency_messages,
    s.ROUTES_TOPIC: limit_messages,
    s.ALERTS_TOPIC: alert_messages,
}


def mixed_gps_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GPS topic with faulty messages: which fault depends on the event type."""
    lat, lng = position(F.col("id") % 100)
    rows = _events(spark, sf_dir).select(
        *_who_and_when(), "event_type", F.col("value").alias("speed"), F.lit("North-East").alias("direction"),
    ).withColumn("timestamp", iso_time(F.col("event_time")))
    full = F.array(lat, lng)
    text = F.to_json(F.struct(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("event_type") == "purchase", "").otherwise(F.col("deviceId")).alias("deviceId"),
        "timestamp",
        F.when(F.col("event_type") != "signup", F.col("speed")).alias("speed"),
        "direction",
        F.when(F.col("event_type") == "view", F.slice(full, 1, 1)).otherwise(full).alias("location"),
    ))
    value = F.when(F.col("event_type") == "error", F.concat(F.lit("{bad "), F.col("id").cast("string"))).otherwise(text)
    return to_envelope(rows, s.GPS_TOPIC, "id", "event_time", [], "id", value=value)
