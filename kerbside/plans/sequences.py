"""Per-device sequences, routes, cache and the batch sinks built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside import schemas as s
from kerbside.operators import cache, joins, map_matching, metrics as m, routes, windows
from kerbside.plans.analysis import DAY, gps_and_limits, wide_metrics
from kerbside.plans.catalogue import WIDE, query
from kerbside.plans.sql_views import ISO, POSTED, using
from kerbside.session import work_folder
from kerbside.sinks import writers
from kerbside.sources import event_views as ev
from kerbside.sources.envelope import iso_time

DEDUPE_SQL = """SELECT id, device AS "deviceId", action, target AS target_speed, coalesce(
      (lag(action, 1) OVER w = action AND abs(lag(target, 1) OVER w - target) < 2), false) OR coalesce(
      (lag(action, 2) OVER w = action AND abs(lag(target, 2) OVER w - target) < 2), false) OR coalesce(
      (lag(action, 3) OVER w = action AND abs(lag(target, 3) OVER w - target) < 2), false) OR coalesce(
      (lag(action, 4) OVER w = action AND abs(lag(target, 4) OVER w - target) < 2), false) AS suppressed
    FROM alerts WINDOW w AS (PARTITION BY device ORDER BY ts, id)"""


@query("alert_dedupe", using("alerts", DEDUPE_SQL))
def alert_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.alert_dedupe(ev.alerts(spark, sf_dir)).select("id", "deviceId", "action", "target_speed", "suppressed")


@query("alerts_json_sink", using("alerts", f"""SELECT "deviceId" AS key, "deviceId", action, target_speed FROM ({DEDUPE_SQL}) WHERE NOT suppressed"""))
def alerts_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that are not near-duplicates, written as keyed JSON messages, read back and parsed."""
    folder = work_folder(spark, "alerts")
    sent = windows.alert_dedupe(ev.alerts(spark, sf_dir)).where(~F.col("suppressed"))
    writers.to_messages(sent, "deviceId", ["deviceId", "action", "target_speed", "reason", "ts"]).write.parquet(folder)
    read = spark.read.schema("key string, value string").parquet(folder)
    rows = read.select("key", F.from_json("value", s.MESSAGES[s.ALERTS_TOPIC]).alias("a"))
    return rows.select("key", "a.deviceId", "a.action", "a.target_speed")


@query("recent_alerts_top5", using("alerts", """SELECT id, device AS "deviceId", action, target AS target_speed,
    CAST(row_number() OVER (PARTITION BY device ORDER BY ts DESC, id DESC) AS INT) AS recency FROM alerts QUALIFY recency <= 5"""))
def recent_alerts_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.recent_alerts(ev.alerts(spark, sf_dir)).select("id", "deviceId", "action", "target_speed", "recency")


THROTTLE_SQL = """WITH RECURSIVE e AS (SELECT event_id AS id, CAST(user_id AS VARCHAR) AS device, ts FROM events),
    f AS (SELECT a.device, a.ts, min(b.ts) AS following FROM e a LEFT JOIN e b ON a.device = b.device AND b.ts >= a.ts + INTERVAL 1 DAY
      GROUP BY ALL),
    chain AS (SELECT device, min(ts) AS ts FROM e GROUP BY device
      UNION ALL SELECT f.device, f.following FROM chain c JOIN f ON c.device = f.device AND c.ts = f.ts WHERE f.following IS NOT NULL)
    SELECT e.id, e.device AS "deviceId", c.ts IS NOT NULL AS emitted FROM e LEFT JOIN chain c ON e.device = c.device AND e.ts = c.ts"""


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("deviceId"), F.col("ts").cast("timestamp").alias("event_time")
    )


@query("advice_throttle", THROTTLE_SQL)
def advice_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.throttle(all_messages(spark, sf_dir), DAY).select("id", "deviceId", "emitted")


@query("route_count_window", using("windows", """SELECT window_no, device AS "deviceId", id, array_to_string(ids, ',') AS fix_ids FROM windows"""))
def route_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_windows(ev.gps(spark, sf_dir)).select("window_no", "deviceId", "id", F.array_join("fix_ids", ",").alias("fix_ids"))


@query("route_count_window_global", using("gps", """, n AS (SELECT *, row_number() OVER (ORDER BY ts, id) - 1 AS n FROM gps)
    SELECT n // 3 AS window_no, arg_max(device, ts) AS "deviceId", arg_max(id, ts) AS id, string_agg(id, ',' ORDER BY ts, id) AS fix_ids
    FROM n GROUP BY n // 3 HAVING count(*) = 3"""))
def route_count_window_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One buffer for all devices, as the source service has it."""
    rows = windows.count_windows(ev.gps(spark, sf_dir), per_device=False)
    return rows.select("window_no", "deviceId", "id", F.array_join("fix_ids", ",").alias("fix_ids"))


@query("snap_nearest_road", using("snapped", """SELECT lat AS latitude, lng AS longitude, place AS "placeId", round(metres, 3) AS distance_m FROM snapped"""))
def snap_nearest_road(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.col("location")
    fixes = ev.gps(spark, sf_dir).select(F.get(place, F.lit(0)).alias("latitude"), F.get(place, F.lit(1)).alias("longitude"))
    rows = joins.snap_to_road(fixes, ev.road_points(spark, sf_dir))
    return rows.select("latitude", "longitude", "placeId", F.round("distance_m", 3).alias("distance_m"))


SNAP_PATH_SQL = """, shaken AS (SELECT id, device, ts, lat + 0.0003::DOUBLE * ((id // 7) % 3 - 1) AS lat, lng FROM gps),
    n AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY ts, id) - 1 AS n FROM shaken),
    f AS (SELECT id, device, lat, lng, n // 3 AS window_no, n % 3 AS step FROM n
      QUALIFY count(*) OVER (PARTITION BY device, n // 3) = 3),
    spots AS (SELECT lat, lng, min(place) AS place, (min(place) // 100) % 3 AS road, (min(place) % 100) * 1635.0::DOUBLE AS along FROM roads GROUP BY lat, lng),
    near AS (SELECT p.lat, p.lng, s.place, s.road, s.along, s.lat AS rlat, s.lng AS rlng, {apart_ps} AS metres
      FROM (SELECT DISTINCT lat, lng FROM f) p JOIN spots s ON s.lat BETWEEN p.lat - 0.002 AND p.lat + 0.002 AND s.lng BETWEEN p.lng - 0.004 AND p.lng + 0.004),
    c AS (SELECT *, round(500.0::DOUBLE * pow(metres / 20.0::DOUBLE, 2))::BIGINT AS cost FROM near WHERE metres <= 200
      QUALIFY row_number() OVER (PARTITION BY lat, lng ORDER BY metres, place) <= 8),
    o AS (SELECT f.id, f.device, f.window_no, f.step, f.lat, f.lng, c.place, c.road, c.along, c.rlat, c.rlng, c.metres, c.cost FROM f JOIN c ON c.lat = f.lat AND c.lng = f.lng),
    ways AS (SELECT a.device, a.window_no, a.place AS p0, b.place AS p1, d.place AS p2, a.cost + b.cost + d.cost
        + round(10 * abs(CASE WHEN a.road = b.road THEN abs(a.along - b.along) ELSE {apart_ab} + 500 END - {straight_ab}))::BIGINT
        + round(10 * abs(CASE WHEN b.road = d.road THEN abs(b.along - d.along) ELSE {apart_bd} + 500 END - {straight_bd}))::BIGINT AS cost
      FROM o a JOIN o b ON b.device = a.device AND b.window_no = a.window_no AND b.step = 1
        JOIN o d ON d.device = a.device AND d.window_no = a.window_no AND d.step = 2 WHERE a.step = 0),
    best AS (SELECT * FROM ways QUALIFY row_number() OVER (PARTITION BY device, window_no ORDER BY cost, p0, p1, p2) = 1)
    SELECT o.device AS "deviceId", o.window_no, o.step::INT AS step, o.id AS fix_id, o.place AS "placeId", o.road AS "roadId", round(o.metres, 3) AS distance_m
    FROM o JOIN best b ON b.device = o.device AND b.window_no = o.window_no AND o.place = CASE o.step WHEN 0 THEN b.p0 WHEN 1 THEN b.p1 ELSE b.p2 END"""


def _apart(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    return f"""(2 * 6371008.8::DOUBLE * asin(least(1, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
      + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lng2}) - radians({lng1})) / 2), 2)))))"""


@query("snap_path", using("gps roads", SNAP_PATH_SQL.format(
    apart_ps=_apart("p.lat", "p.lng", "s.lat", "s.lng"), apart_ab=_apart("a.rlat", "a.rlng", "b.rlat", "b.rlng"), apart_bd=_apart("b.rlat", "b.rlng", "d.rlat", "d.rlng"),
    straight_ab=_apart("a.lat", "a.lng", "b.lat", "b.lng"), straight_bd=_apart("b.lat", "b.lng", "d.lat", "d.lng"))))
def snap_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of three fixes, seen beside their road, matched to three parallel roads."""
    paths = windows.count_windows(ev.shaken(ev.gps(spark, sf_dir)), 3)
    return map_matching.snap_path(paths, ev.parallel_roads(spark, sf_dir)).withColumn("distance_m", F.round("distance_m", 3))


def snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routes.snapped_routes(ev.gps(spark, sf_dir), ev.road_points(spark, sf_dir))


@query("routes_json_sink", using("routes", f"""SELECT device AS key, device AS "deviceId", CAST(place AS VARCHAR) AS "placeId",
    strftime(ts, {ISO}) AS timestamp, ({POSTED})[place % 8 + 1] AS "SpeedLimit" FROM routes"""))
def routes_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every three fixes snapped, given a limit and written as a keyed JSON message; read back and parsed."""
    folder = work_folder(spark, "routes")
    sent = routes.route_messages(routes.with_assigned_limit(snapped(spark, sf_dir)))
    writers.to_messages(sent, "deviceID").write.parquet(folder)
    read = spark.read.schema("key string, value string").parquet(folder)
    fields = "deviceID string, placeId string, timestamp string, SpeedLimit double"
    return read.select("key", F.from_json("value", fields).alias("r")).select(
        "key", F.col("r.deviceID").alias("deviceId"), "r.placeId", "r.timestamp", "r.SpeedLimit"
    )


@query("route_cache_write", using("routes", f"""SELECT 'route:' || lats[3] || ':' || lngs[3] AS key, arg_max(place, (ts, id)) AS "placeId",
    strftime(max(ts), {ISO}) AS written_at, strftime(max(ts) + INTERVAL 1 HOUR, {ISO}) AS expires_at FROM routes GROUP BY ALL"""))
def route_cache_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cache.cache_write(routes.cache_writes(snapped(spark, sf_dir)))
    return rows.select("key", F.get_json_object("value", "$.place_id").cast("bigint").alias("placeId"),
                       iso_time(F.col("written_at")).alias("written_at"), iso_time(F.col("expires_at")).alias("expires_at"))


@query("route_cache_misses_snapped", using("routes", """, mid AS (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 AS at FROM routes),
    w AS (SELECT 'route:' || lats[3] || ':' || lngs[3] AS key, ts AS written, place FROM routes, mid WHERE epoch_us(ts) < mid.at
      QUALIFY row_number() OVER (PARTITION BY key, ts ORDER BY id DESC) = 1),
    r AS (SELECT id, 'route:' || lats[3] || ':' || lngs[3] AS key, ts, place FROM routes, mid WHERE epoch_us(ts) >= mid.at),
    f AS (SELECT r.id, r.place, CASE WHEN r.ts < w.written + INTERVAL 5 DAY THEN w.place END AS held
      FROM r ASOF LEFT JOIN w ON r.key = w.key AND r.ts >= w.written)
    SELECT id, coalesce(held, place) AS "placeId", held IS NOT NULL AS cached FROM f"""))
def route_cache_misses_snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the first half of the time fill the cache; those of the second look there first and snap the rest."""
    every = windows.count_windows(ev.gps(spark, sf_dir))
    roads = ev.road_points(spark, sf_dir)
    placed = routes.snap_windows(every, roads)
    first, last = placed.agg(F.unix_micros(F.min("event_time")), F.unix_micros(F.max("event_time"))).first()
    early = F.unix_micros("event_time") < ((first or 0) + (last or 0)) // 2
    found = routes.cached_or_snapped(every.where(~early), roads, routes.cache_writes(placed.where(early)), "5 days")
    return found.select("id", "placeId", "cached")


def cache_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    key = F.concat(F.lit("route:"), F.col("id") % 97)
    reads = ev.gps(spark, sf_dir).select(key.alias("key"), "id", "event_time")
    writes = ev.limits(spark, sf_dir).select(key.alias("key"), F.col("SpeedLimit").cast("string").alias("value"), "id", "event_time")
    return reads, writes


CACHE_SQL = """, w AS (SELECT 'route:' || id % 97 AS key, CAST(lim AS VARCHAR) AS value, ts AS at FROM lim),
    r AS (SELECT 'route:' || id % 97 AS key, id, ts FROM gps),
    found AS (SELECT r.key, r.id, CASE WHEN r.ts < w.at + INTERVAL 1 HOUR THEN value END AS value FROM r ASOF LEFT JOIN w ON r.key = w.key AND r.ts >= w.at)"""


@query("route_cache_lookup", using("gps lim", CACHE_SQL + " SELECT * FROM found"))
def route_cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache.cache_lookup(*cache_sides(spark, sf_dir)).select("key", "id", "value")


@query("route_cache_hits", using("gps lim", CACHE_SQL + " SELECT key, count(*) AS reads, count(value) AS hits FROM found GROUP BY key"))
def route_cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cache.cache_hits(*cache_sides(spark, sf_dir))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("reads"), F.sum(F.col("hit").cast("bigint")).alias("hits"))


@query("speed_limit_lookup", using("lim", f""", posted AS (SELECT CAST(p_partkey AS VARCHAR) AS place, ({POSTED})[p_size % 8 + 1] AS posted FROM part
      WHERE p_type <> 'ECONOMY')
    SELECT l.id, l.place AS "placeId", coalesce(p.posted, ({POSTED})[CAST(l.place AS INT) % 8 + 1]) AS "SpeedLimit"
    FROM lim l LEFT JOIN posted p ON l.place = p.place"""))
def speed_limit_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kerbside.functions.rules import posted_limit

    posted = ev.table(spark, sf_dir, "part").where("p_type <> 'ECONOMY'").select(
        F.col("p_partkey").cast("string").alias("placeId"), posted_limit(F.col("p_size")).alias("speedLimit")
    )
    fixes = ev.limits(spark, sf_dir).select("id", "placeId")
    return joins.speed_limit_lookup(fixes, posted).select("id", "placeId", "SpeedLimit")


@query("journey_until_arrival", using("gps", """, first AS (SELECT device, min(ts) AS ts FROM gps
      WHERE lat >= 51.5074::DOUBLE + 0.009788::DOUBLE * 90 AND lng <= (-0.1278)::DOUBLE - 0.017626::DOUBLE * 90 GROUP BY device)
    SELECT g.id, g.device AS "deviceId" FROM gps g LEFT JOIN first f ON g.device = f.device WHERE f.ts IS NULL OR g.ts < f.ts"""))
def journey_until_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test journeys reach at most 99 of 100 steps, so the destination here is step 90."""
    goal = (s.JOURNEY_START[0] + ev.LAT_STEP * 90, s.JOURNEY_START[1] - ev.LNG_STEP * 90)
    return routes.journey_until_arrival(ev.gps(spark, sf_dir), goal).select("id", "deviceId")


@query("debug_tap_counts", using("metrics", """SELECT 'gps' AS tag, count(*) AS rows_seen FROM gps
    UNION ALL SELECT 'speed limits', count(*) FROM lim
    UNION ALL SELECT 'joined', count(*) FROM gps g LEFT JOIN lim l ON g.device = l.device AND g.ts BETWEEN l.ts - INTERVAL 1 DAY AND l.ts + INTERVAL 1 DAY
    UNION ALL SELECT 'filtered', count(*) FROM over UNION ALL SELECT 'metrics', count(*) FROM metrics"""))
def debug_tap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps, limits = gps_and_limits(spark, sf_dir)
    return writers.tap_counts({
        "gps": gps, "speed limits": limits,
        "joined": joins.interval_join(gps, m.as_limit_side(limits), DAY),
        "filtered": m.overspeed_rows(gps, limits, DAY), "metrics": m.overspeed_metrics(gps, limits, **WIDE),
    })


@query("ingest_metrics", using("metrics", "SELECT * FROM metrics"))
def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kerbside.sources import topics

    sent = writers.to_messages(wide_metrics(spark, sf_dir)).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit(s.METRICS_TOPIC).alias("topic")
    )
    return topics.topic_stream(sent, s.METRICS_TOPIC).drop("event_time")
