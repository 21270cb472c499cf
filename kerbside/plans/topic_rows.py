"""The joins, windows and scores on rows as the topic readers give them: text ids, or none at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside import schemas as s
from kerbside.operators import joins, metrics as m, weather as w, windows
from kerbside.plans.analysis import DAY, METRIC, metric_rows, metrics_sql
from kerbside.plans.catalogue import WIDE, query
from kerbside.plans.sequences import DEDUPE_SQL
from kerbside.plans.sql_views import using
from kerbside.sources import event_views as ev, topics


def read(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Parsed rows of a topic; message ids are text that is no number."""
    log = ev.MESSAGES[topic](spark, sf_dir)
    sent = F.regexp_replace(log["value"].cast("string"), r'"id":"([0-9]+)"', r'"id":"m-$1-x"')
    return topics.topic_stream(log.withColumn("value", sent.cast("binary")), topic)


def number(column: str = "id"):
    return F.regexp_extract(column, "[0-9]+", 0).cast("bigint").alias("id")


@query("overspeed_metrics_asof_topics", using("gps lim", metrics_sql(
    "SELECT g.device, g.ts, g.speed, l.lim FROM gps g ASOF JOIN lim l ON g.device = l.device AND g.ts >= l.ts", "DAY")))
def overspeed_metrics_asof_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps, limits = read(spark, sf_dir, s.GPS_TOPIC), read(spark, sf_dir, s.ROUTES_TOPIC)
    return metric_rows(m.overspeed_metrics_asof(gps, limits, window=DAY))


@query("driver_scorecard_topics", using("classed", "SELECT * FROM classed"))
def driver_scorecard_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps, limits, weather, alerts = (read(spark, sf_dir, t) for t in (s.GPS_TOPIC, s.ROUTES_TOPIC, s.WEATHER_TOPIC, s.ALERTS_TOPIC))
    card = m.driver_scorecard(gps, limits, weather, alerts, **WIDE, horizon=DAY)
    return metric_rows(card, "risky_weather_overspeed", "ignored_alerts", "rating", "class")


@query("alert_dedupe_topics", using("alerts", f"""SELECT d."deviceId", d.action, d.target_speed, a.reason, d.suppressed
    FROM ({DEDUPE_SQL}) d JOIN alerts a ON d.id = a.id"""))
def alert_dedupe_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts carry no id; at one instant they are ordered by what they say."""
    alerts = read(spark, sf_dir, s.ALERTS_TOPIC)
    return windows.alert_dedupe(alerts).select("deviceId", "action", "target_speed", "reason", "suppressed")


@query("weather_enrich_topics", using("gps weather", """, o AS (SELECT *, floor(lat / 0.1) AS x, floor(lng / 0.1) AS y FROM weather),
    p AS (SELECT *, floor(lat / 0.1) AS x, floor(lng / 0.1) AS y FROM gps),
    f AS (SELECT p.id, p.ts, o.ts AS seen, o.label, o.temperature FROM p ASOF LEFT JOIN o ON p.x = o.x AND p.y = o.y AND p.ts >= o.ts)
    SELECT id, label AS "weatherCondition", temperature FROM f WHERE seen >= ts - INTERVAL 1 DAY"""))
def weather_enrich_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixes with an observation of their cell in the last day; what the fall-back draws depends on the text id."""
    gps, observed = read(spark, sf_dir, s.GPS_TOPIC), read(spark, sf_dir, s.WEATHER_TOPIC)
    places = gps.select("id", "event_time", F.get("location", F.lit(0)).alias("latitude"), F.get("location", F.lit(1)).alias("longitude"))
    rows = w.weather_enrich(places, observed.select("*", "location.latitude", "location.longitude"), 0.1, DAY)
    return rows.where("observed").select(number(), "weatherCondition", "temperature")


@query("all_streams_joined_topics", using("gps vehicles traffic weather emergency lim", """SELECT g.id, g.device AS "deviceId", g.speed, l.lim AS "SpeedLimit",
    v.make, t.camera AS "cameraID", w.label AS "weatherCondition", e.kind AS type, e.status FROM gps g
    ASOF LEFT JOIN vehicles v ON g.device = v.device AND g.ts >= v.ts ASOF LEFT JOIN traffic t ON g.device = t.device AND g.ts >= t.ts
    ASOF LEFT JOIN weather w ON g.device = w.device AND g.ts >= w.ts ASOF LEFT JOIN emergency e ON g.device = e.device AND g.ts >= e.ts
    ASOF LEFT JOIN lim l ON g.device = l.device AND g.ts >= l.ts"""))
def all_streams_joined_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = {
        "vehicle": (read(spark, sf_dir, s.VEHICLE_TOPIC), ["make"]),
        "traffic": (read(spark, sf_dir, s.TRAFFIC_TOPIC), ["cameraID"]),
        "weather": (read(spark, sf_dir, s.WEATHER_TOPIC), ["weatherCondition"]),
        "emergency": (read(spark, sf_dir, s.EMERGENCY_TOPIC), ["type", "status"]),
        "limit": (read(spark, sf_dir, s.ROUTES_TOPIC), ["SpeedLimit"]),
    }
    gps = read(spark, sf_dir, s.GPS_TOPIC).drop("SpeedLimit")
    rows = joins.as_of_many(gps, sides, ["deviceId"], F.col("event_time"), ["id"])
    return rows.select(number(), "deviceId", "speed", "limit.SpeedLimit", "vehicle.make", "traffic.cameraID",
                       "weather.weatherCondition", "emergency.type", "emergency.status")


MANY = """(CASE WHEN id % 50 = 0 THEN 'NaN'::DOUBLE ELSE (id % 1000) / 7.0::DOUBLE END)"""


@query("overspeed_metrics_many_limits", using("gps lim", metrics_sql(
    f"""SELECT g.device, g.ts, g.speed, l.lim FROM gps g JOIN (SELECT device, ts, {MANY} AS lim FROM lim) l ON g.device = l.device
    AND g.ts BETWEEN l.ts - INTERVAL 1 DAY AND l.ts + INTERVAL 1 DAY WHERE NOT isnan(l.lim)""", "DAY").replace(
        "round(sum(speed - lim), 2) / count(*) AS avg_speed_over_limit", "round(sum(speed - lim) / count(*), 6) AS avg_speed_over_limit").replace(
        "max(speed - lim) AS", "round(max(speed - lim), 6) AS")))
def overspeed_metrics_many_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hundreds of distinct limits and some that are no number, by the same plan as eight of them."""
    limit = F.when(F.col("id") % 50 == 0, F.lit(float("nan"))).otherwise((F.col("id") % 1000) / 7.0)
    rows = m.overspeed_metrics(ev.gps(spark, sf_dir), ev.limits(spark, sf_dir).withColumn("SpeedLimit", limit), **WIDE)
    return rows.select(*[F.round(c, 6).alias(c) if c.endswith("over_limit") else F.col(c) for c in METRIC])
