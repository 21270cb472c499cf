"""Reading, parsing, validating and archiving topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kerbside import schemas as s
from kerbside.functions import rules, text
from kerbside.functions.rules import weather_label
from kerbside.operators.weather import weather_enrich as enrich_with_weather
from kerbside.plans.catalogue import query
from kerbside.plans.sql_views import ISO, K, LABELS, LAT, LNG, POSTED, SEC, using
from kerbside.sources import event_views as ev, topics
from kerbside.sources.envelope import iso_time

ASSISTANT_TOPICS = [s.GPS_TOPIC, s.WEATHER_TOPIC, s.TRAFFIC_TOPIC, s.EMERGENCY_TOPIC, s.ROUTES_TOPIC]


def when(column: str = "event_time") -> Column:
    return iso_time(F.col(column)).alias("event_time")


def number(column: str) -> Column:
    return F.col(column).cast("bigint").alias(column)


@query("ingest_gps", using("gps", f"""SELECT id, device AS "deviceId", strftime(ts, {ISO}) AS event_time, speed,
    'North-East' AS direction, 'private' AS vehicle_type FROM gps"""))
def ingest_gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.topic_stream(ev.gps_messages(spark, sf_dir), s.GPS_TOPIC)
    return rows.select(number("id"), "deviceId", when(), "speed", "direction", "vehicle_type")


@query("ingest_speed_limits", using("lim", f"""SELECT device AS "deviceId_sl", place AS "placeId", lim AS "SpeedLimit",
    strftime(ts, {ISO}) AS event_time FROM lim"""))
def ingest_speed_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.speed_limit_stream(ev.limit_messages(spark, sf_dir), s.ROUTES_TOPIC)
    return rows.select("deviceId_sl", "placeId", "SpeedLimit", when("event_time_speed"))


@query("ingest_alerts", using("alerts", """SELECT device AS "deviceId", action, target AS target_speed, reason, ms AS ts FROM alerts"""))
def ingest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.alert_stream(ev.alert_messages(spark, sf_dir)).select("deviceId", "action", "target_speed", "reason", "ts")


@query("alert_event_time", using("alerts", f"""SELECT device AS "deviceId", ms AS ts, strftime(make_timestamp(ms * 1000), {ISO}) AS event_time
    FROM alerts"""))
def alert_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.alert_stream(ev.alert_messages(spark, sf_dir)).select("deviceId", "ts", when())


TOPIC_COLUMNS = {
    s.VEHICLE_TOPIC: ["make", "model", "year", "fuelType", "auto_braking_supported", "abs_supported", "traction_control_supported"],
    s.TRAFFIC_TOPIC: ["cameraID", "snapshot"],
    s.WEATHER_TOPIC: ["temperature", "weatherCondition", "windSpeed"],
    s.EMERGENCY_TOPIC: ["incidentId", "type", "status", "description"],
}
TOPIC_SQL = {
    s.VEHICLE_TOPIC: ("vehicles", """make, model, year, 'Hybrid' AS "fuelType", auto_braking AS auto_braking_supported,
        abs_system AS abs_supported, traction AS traction_control_supported"""),
    s.TRAFFIC_TOPIC: ("traffic", """camera AS "cameraID", 'Base64EncodedString' AS snapshot"""),
    s.WEATHER_TOPIC: ("weather", """temperature, label AS "weatherCondition", wind AS "windSpeed" """),
    s.EMERGENCY_TOPIC: ("emergency", """incident AS "incidentId", kind AS type, status, 'Description of the incident' AS description"""),
}


def _register_topic(topic: str) -> None:
    short = topic.removesuffix("_data")
    view, columns = TOPIC_SQL[topic]

    @query(f"ingest_topic_{short}", using(view, f"""SELECT id, device AS "deviceId", strftime(ts, {ISO}) AS event_time, {columns}
        FROM {view}"""))
    def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = topics.topic_stream(ev.MESSAGES[topic](spark, sf_dir), topic)
        return rows.select(number("id"), "deviceId", when(), *TOPIC_COLUMNS[topic])

    step = "id % 100"
    @query(f"parse_{short}_json", using(view, f"""SELECT CAST(id AS VARCHAR) AS id, device AS "deviceId",
        strftime(ts, {ISO}) AS timestamp, 51.5074::DOUBLE + 0.009788::DOUBLE * ({step}) AS latitude,
        (-0.1278)::DOUBLE - 0.017626::DOUBLE * ({step}) AS longitude, {columns} FROM {view}"""))
    def parse(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = topics.parse_messages(ev.MESSAGES[topic](spark, sf_dir), s.MESSAGES[topic])
        return rows.select("id", "deviceId", "timestamp", "location.latitude", "location.longitude", *TOPIC_COLUMNS[topic])


for _topic in TOPIC_COLUMNS:
    _register_topic(_topic)


@query("parse_gps_json", using("gps", f"""SELECT device AS "deviceId", speed, strftime(ts, {ISO}) AS timestamp FROM gps"""))
def parse_gps_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow read of the metrics job: three fields, declared as a DDL string."""
    narrow = "deviceId STRING, speed DOUBLE, timestamp STRING"
    rows = ev.gps_messages(spark, sf_dir).select(F.from_json(F.col("value").cast("string"), narrow).alias("d"))
    return rows.select("d.*")


@query("parse_gps_archive_json", using("gps", f"""SELECT CAST(id AS VARCHAR) AS id, device AS "deviceId",
    strftime(ts, {ISO}) AS timestamp, speed, 'North-East' AS direction, 'private' AS vehicle_type, lat AS latitude,
    lng AS longitude FROM gps"""))
def parse_gps_archive_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.parse_messages(ev.gps_messages(spark, sf_dir), s.MESSAGES[s.GPS_TOPIC])
    place = F.col("location")
    return rows.select("id", "deviceId", "timestamp", "speed", "direction", "vehicle_type",
                       F.get(place, F.lit(0)).alias("latitude"), F.get(place, F.lit(1)).alias("longitude"))


@query("ingest_multi_topic", using("gps weather traffic emergency lim", f"""
    SELECT 'gps_data' AS topic, device AS "deviceId", strftime(ts, {ISO}) AS event_time, speed, NULL AS "weatherCondition",
      NULL AS "cameraID", NULL AS status, NULL::DOUBLE AS "SpeedLimit" FROM gps
    UNION ALL SELECT 'weather_data', device, strftime(ts, {ISO}), NULL, label, NULL, NULL, NULL FROM weather
    UNION ALL SELECT 'traffic_data', device, strftime(ts, {ISO}), NULL, NULL, camera, NULL, NULL FROM traffic
    UNION ALL SELECT 'emergency_data', device, strftime(ts, {ISO}), NULL, NULL, NULL, status, NULL FROM emergency
    UNION ALL SELECT 'optimized_routes', device, strftime(ts, {ISO}), NULL, NULL, NULL, NULL, lim FROM lim"""))
def ingest_multi_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kerbside.operators.timeline import union_all

    log = union_all([build(spark, sf_dir) for build in ev.MESSAGES.values()])
    rows = topics.multi_topic_stream(log, ASSISTANT_TOPICS)
    return rows.select("topic", "deviceId", when(), "speed", "weatherCondition", "cameraID", "status", "SpeedLimit")


@query("parse_event_time", f"""SELECT event_id AS id, CASE event_type WHEN 'error' THEN NULL
    WHEN 'view' THEN strftime(date_trunc('second', ts), {ISO}) ELSE strftime(ts, {ISO}) END AS event_time FROM events""")
def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with a fraction, without one, and junk."""
    rows = ev.table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    sent = F.when(F.col("event_type") == "error", "junk").when(
        F.col("event_type") == "view", F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(iso_time(F.col("at")))
    return rows.select(F.col("event_id").alias("id"), iso_time(F.try_to_timestamp(sent)).alias("event_time"))


@query("event_time_unix", using("gps", "SELECT id, CAST(floor(epoch(ts)) AS BIGINT) AS event_time_unix FROM gps"))
def event_time_unix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.gps(spark, sf_dir).select("id", F.unix_timestamp("event_time").alias("event_time_unix"))


@query("period_label", using("gps", f"""SELECT id, strftime(time_bucket(INTERVAL 1 MINUTE, ts), {SEC}) || '/' ||
    strftime(time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE, {SEC}) AS period FROM gps"""))
def period_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.window("event_time", "1 minute")
    return ev.gps(spark, sf_dir).select("id", w.alias("w")).select("id", text.period_label(F.col("w.start"), F.col("w.end")).alias("period"))


GOOD = "event_type = 'click'"


@query("validate_gps", f"""SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS "deviceId",
    strftime(ts, {ISO}) AS event_time, value AS speed, 'North-East' AS direction, 'private' AS vehicle_type,
    CASE event_type WHEN 'view' THEN 1 ELSE 2 END AS coordinates FROM events WHERE event_type IN ('click', 'view')""")
def validate_gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.valid_gps(topics.validate_gps(ev.mixed_gps_messages(spark, sf_dir)))
    return rows.select("id", "deviceId", when(), "speed", "direction", "vehicle_type", F.size("location").alias("coordinates"))


@query("valid_location", f"""SELECT CAST(event_id AS VARCHAR) AS id, {LAT} AS latitude, {LNG} AS longitude FROM events WHERE {GOOD}""")
def valid_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.valid_gps(topics.validate_gps(ev.mixed_gps_messages(spark, sf_dir)))
    place = F.col("location")
    return rows.where(topics.has_two_coordinates(place)).select(
        "id", F.get(place, F.lit(0)).alias("latitude"), F.get(place, F.lit(1)).alias("longitude")
    )


@query("quarantine_gps", """SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'purchase' THEN 'deviceId' ELSE 'speed' END
    AS reject_reason, CASE event_type WHEN 'error' THEN '{bad ' || event_id ELSE CAST(event_id AS VARCHAR) END AS subject
    FROM events WHERE event_type IN ('error', 'purchase', 'signup')""")
def quarantine_gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.rejected_gps(topics.validate_gps(ev.mixed_gps_messages(spark, sf_dir)))
    return rows.select("reject_reason", F.coalesce(F.get_json_object("message", "$.id"), F.col("message")).alias("subject"))


@query("quarantine_malformed", """SELECT '{bad ' || event_id AS message, 'malformed' AS reject_reason FROM events
    WHERE event_type = 'error'""")
def quarantine_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topics.parse_messages(ev.mixed_gps_messages(spark, sf_dir), s.MESSAGES[s.GPS_TOPIC])
    return topics.quarantine(rows).select(F.col(topics.CORRUPT).alias("message"), "reject_reason")


@query("device_id_coalesce", using("lim", """SELECT device AS "deviceId", count(*) AS records FROM lim GROUP BY device"""))
def device_id_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a device under either spelling; records without one (empty id) are dropped."""
    nameless = ev.mixed_gps_messages(spark, sf_dir).select(
        "key", F.regexp_replace(F.col("value").cast("string"), '"deviceId":"[^"]*"', '"deviceId":""').cast("binary").alias("value"),
        F.lit(s.ROUTES_TOPIC).alias("topic"), "partition", "offset", "timestamp",
    )
    rows = topics.topic_stream(ev.limit_messages(spark, sf_dir).unionByName(nameless), s.ROUTES_TOPIC)
    return rows.groupBy("deviceId").agg(F.count(F.lit(1)).alias("records"))


@query("first_snapped_point", using("lim", """SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE place END AS "placeId",
    CASE WHEN id % 3 = 0 THEN NULL ELSE lim / 2 END AS latitude, CASE WHEN id % 3 = 2 THEN 0 END AS original_index FROM lim"""))
def first_snapped_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapping answers with no points, with one without optional fields and unknown extras, and with two points."""
    rows = ev.limits(spark, sf_dir)
    lat = (F.col("SpeedLimit") / 2).cast("string")
    point = F.concat(F.lit('{"location":{"latitude":'), lat, F.lit(',"longitude":1.5},"placeId":"'), F.col("placeId"), F.lit('"'))
    answer = F.when(F.col("id") % 3 == 0, "[]").when(
        F.col("id") % 3 == 1, F.concat(F.lit("["), point, F.lit(',"extra":true}]'))
    ).otherwise(F.concat(F.lit("["), point, F.lit(',"originalIndex":0},'), point, F.lit(',"originalIndex":1}]')))
    first = text.first_snapped_point(answer)
    return rows.select("id", first["placeId"].alias("placeId"), first["location"]["latitude"].alias("latitude"),
                       first["originalIndex"].alias("original_index"))


@query("first_speed_limit", using("lim", "SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE lim END AS speed_limit FROM lim"))
def first_speed_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.to_json(F.struct("placeId", F.col("SpeedLimit").alias("speedLimit")))
    answer = F.when(F.col("id") % 3 == 0, '{"speedLimits":[]}').otherwise(
        F.concat(F.lit('{"speedLimits":['), entry, F.lit(',{"placeId":"x","speedLimit":1.0}]}'))
    )
    return ev.limits(spark, sf_dir).select("id", text.first_speed_limit(answer).alias("speed_limit"))


@query("route_path_text", using("gps", """SELECT id, lat || ',' || lng || '%7C' || lng || ',' || lat AS path FROM gps"""))
def route_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.gps(spark, sf_dir).select("id", text.route_path(F.array("location", F.reverse("location"))).alias("path"))


@query("assign_speed_limit", f"""SELECT event_id AS id, ({POSTED})[event_id % 8 + 1] AS "SpeedLimit" FROM events""")
def assign_speed_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), rules.posted_limit(F.col("event_id")).alias("SpeedLimit"))


@query("weather_code_label", f"""SELECT event_id AS id, event_id % 100 AS code, coalesce(({LABELS})[
    list_position([0, 1, 2, 3, 45, 48, 51, 53, 55, 61, 63, 65, 71, 73, 75, 95, 96, 99], event_id % 100)], 'Unknown') AS label FROM events""")
def weather_code_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("event_id") % 100
    return ev.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), code.alias("code"), weather_label(code).alias("label"))


@query("road_condition", using("weather", """SELECT id, label, CASE label WHEN 'Fog' THEN 'Low-visibility' WHEN 'Heavy Rain' THEN 'Wet'
    WHEN 'Snow' THEN 'Snow-covered' WHEN 'Ice' THEN 'Icy' ELSE 'Normal' END AS road,
    CASE label WHEN 'Clear sky' THEN 22 WHEN 'Fog' THEN 5 WHEN 'Heavy Rain' THEN 12 WHEN 'Snow' THEN -1 WHEN 'Ice' THEN -3 END AS typical
    FROM (SELECT id, CASE WHEN id % 5 = 0 THEN (['Heavy Rain', 'Snow', 'Ice'])[id % 3 + 1] ELSE label END AS label FROM weather)"""))
def road_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("id") % 5 == 0, F.get(F.array(F.lit("Heavy Rain"), F.lit("Snow"), F.lit("Ice")), (F.col("id") % 3).cast("int")))
    rows = ev.weather(spark, sf_dir).select("id", F.coalesce(label, "weatherCondition").alias("label"))
    return rows.select("id", "label", rules.road_condition(F.col("label")).alias("road"), rules.typical_temperature(F.col("label")).alias("typical"))


@query("weather_enrich", using("gps weather", """
    , p AS (SELECT id, ts, floor(lat / 0.1::DOUBLE) AS x, floor(lng / 0.1::DOUBLE) AS y FROM gps),
    o AS (SELECT id AS oid, ts, floor(lat / 0.1::DOUBLE) AS x, floor(lng / 0.1::DOUBLE) AS y, temperature, label, wind FROM weather),
    m AS (SELECT p.id, o.oid, o.temperature, o.label, o.wind, o.ts >= p.ts - INTERVAL 1 HOUR AS fresh
      FROM p ASOF LEFT JOIN o ON p.x = o.x AND p.y = o.y AND p.ts >= o.ts)
    SELECT id, coalesce(fresh, false) AS observed, CASE WHEN fresh THEN temperature ELSE id % 32 - 5 END AS temperature,
      CASE WHEN fresh THEN label ELSE (['Sunny', 'Cloudy', 'Rain', 'Snow'])[id % 4 + 1] END AS "weatherCondition",
      CASE WHEN fresh THEN wind ELSE id % 101 END AS "windSpeed",
      CASE WHEN fresh THEN NULL ELSE CAST(id % 26 AS DOUBLE) END AS precipitation,
      CASE WHEN fresh THEN NULL ELSE CAST(id % 101 AS INT) END AS humidity,
      CASE WHEN fresh THEN NULL ELSE CAST(id % 501 AS DOUBLE) END AS "airQualityIndex" FROM m"""))
def weather_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.col("location")
    fixes = ev.gps(spark, sf_dir).select("id", "event_time", F.get(place, F.lit(0)).alias("latitude"), F.get(place, F.lit(1)).alias("longitude"))
    return enrich_with_weather(fixes, ev.weather(spark, sf_dir)).select(
        "id", "observed", "temperature", "weatherCondition", "windSpeed", "precipitation", "humidity", "airQualityIndex"
    )
