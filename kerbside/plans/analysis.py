"""Joins, metrics and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kerbside import schemas as s
from kerbside.functions import rules, text
from kerbside.operators import joins, metrics as m, routes, state, windows
from kerbside.plans.catalogue import WIDE, query
from kerbside.plans.sql_views import ISO, POSTED, SEC, using
from kerbside.session import work_folder
from kerbside.sinks import writers
from kerbside.sources import event_views as ev
from kerbside.sources.envelope import iso_time

METRIC = ["deviceId", "period", "avg_speed_over_limit", "overspeed_events", "max_speed_over_limit"]
DAY = "1 day"


def settled(column: str, count: str) -> Column:
    """An average without the noise of summation order: test values have two decimals, so their sum has too."""
    return F.try_divide(F.round(F.col(column) * F.col(count), 2), F.col(count)).alias(column)


def metric_rows(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select("deviceId", "period", settled("avg_speed_over_limit", "overspeed_events"), "overspeed_events",
                       "max_speed_over_limit", *extra)


def gps_and_limits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return ev.gps(spark, sf_dir), ev.limits(spark, sf_dir)


def wide_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(m.overspeed_metrics(*gps_and_limits(spark, sf_dir), **WIDE))


@query("overspeed_metrics", using("metrics", "SELECT * FROM metrics"))
def overspeed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_metrics(spark, sf_dir)


def metrics_sql(pairs: str, unit: str) -> str:
    bucket = f"time_bucket(INTERVAL 1 {unit}, ts)"
    return f"""SELECT device AS "deviceId", strftime({bucket}, {SEC}) || '/' || strftime({bucket} + INTERVAL 1 {unit}, {SEC}) AS period,
        round(sum(speed - lim), 2) / count(*) AS avg_speed_over_limit, count(*) AS overspeed_events,
        max(speed - lim) AS max_speed_over_limit FROM ({pairs}) WHERE speed > lim GROUP BY device, {bucket}"""


@query("overspeed_metrics_default", using("gps lim", metrics_sql(
    """SELECT g.device, g.ts, g.speed, l.lim FROM gps g JOIN lim l ON g.device = l.device
    AND g.ts BETWEEN l.ts - INTERVAL 5 MINUTE AND l.ts + INTERVAL 5 MINUTE""", "MINUTE")))
def overspeed_metrics_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(m.overspeed_metrics(*gps_and_limits(spark, sf_dir)))


@query("overspeed_metrics_asof", using("gps lim", metrics_sql(
    "SELECT g.device, g.ts, g.speed, l.lim FROM gps g ASOF JOIN lim l ON g.device = l.device AND g.ts >= l.ts", "DAY")))
def overspeed_metrics_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(m.overspeed_metrics_asof(*gps_and_limits(spark, sf_dir), window=DAY))


def pairs(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    gps, limits = gps_and_limits(spark, sf_dir)
    renamed = limits.select(F.col("id").alias("limit_id"), F.col("deviceId").alias("deviceId_sl"), "SpeedLimit",
                            F.col("event_time").alias("event_time_speed"))
    return joins.interval_join(gps, renamed, DAY, how).select("id", "deviceId", "speed", "limit_id", "SpeedLimit")


PAIR_SQL = """SELECT g.id, g.device AS "deviceId", g.speed, l.id AS limit_id, l.lim AS "SpeedLimit" FROM gps g {how} JOIN lim l
    ON g.device = l.device AND g.ts BETWEEN l.ts - INTERVAL 1 DAY AND l.ts + INTERVAL 1 DAY"""


@query("gps_limits_interval_left", using("gps lim", PAIR_SQL.format(how="LEFT")))
def gps_limits_interval_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir, "left")


@query("gps_limits_interval_inner", using("gps lim", PAIR_SQL.format(how="")))
def gps_limits_interval_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir, "inner")


@query("overspeed_rows", using("over", """SELECT id, device AS "deviceId", speed, lim AS "SpeedLimit" FROM over"""))
def overspeed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.overspeed_rows(*gps_and_limits(spark, sf_dir), DAY).select("id", "deviceId", "speed", "SpeedLimit")


@query("hard_braking", using("gps", """SELECT id, device AS "deviceId", before AS speed_before, speed, before - speed AS speed_drop FROM (
    SELECT *, lag(speed) OVER w AS before, lag(ts) OVER w AS last FROM gps WINDOW w AS (PARTITION BY device ORDER BY ts, id))
    WHERE before - speed >= 20 AND ts - last <= INTERVAL 1 DAY"""))
def hard_braking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = m.hard_braking(ev.gps(spark, sf_dir), threshold=20.0, max_gap=DAY)
    return rows.select("id", "deviceId", "speed_before", "speed", "speed_drop")


TRIPS_SQL = """, flagged AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS s
      FROM gps WINDOW w AS (PARTITION BY device ORDER BY ts, id)),
    tripped AS (SELECT *, sum(s) OVER (PARTITION BY device ORDER BY ts, id) AS trip FROM flagged),
    trips AS (SELECT device, trip, min(ts) AS b, max(ts) AS e, count(*) AS fixes, sum(speed) AS total, max(speed) AS top
      FROM tripped GROUP BY ALL)"""


@query("trip_summary", using("gps over", TRIPS_SQL + f""",
    counted AS (SELECT t.device, t.trip, count(*) AS n FROM over o JOIN tripped t ON o.id = t.id GROUP BY ALL)
    SELECT t.device AS "deviceId", strftime(b, {ISO}) AS trip_start, strftime(e, {ISO}) AS trip_end,
      (epoch_us(e) - epoch_us(b)) / 1e6::DOUBLE AS duration_s, fixes, round(total, 2) / fixes AS avg_speed, top AS max_speed,
      coalesce(n, 0) AS overspeed_events FROM trips t LEFT JOIN counted c ON t.device = c.device AND t.trip = c.trip"""))
def trip_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = m.trip_summary(*gps_and_limits(spark, sf_dir), gap="12 hours", tolerance=DAY)
    return rows.select("deviceId", iso_time(F.col("trip_start")).alias("trip_start"), iso_time(F.col("trip_end")).alias("trip_end"),
                       "duration_s", "fixes", settled("avg_speed", "fixes"), "max_speed", "overspeed_events")


@query("risky_weather_overspeed", using("risky", "SELECT * FROM risky"))
def risky_weather_overspeed(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps, limits = gps_and_limits(spark, sf_dir)
    return m.metrics_with_weather(gps, ev.weather(spark, sf_dir), limits, **WIDE).select("deviceId", "period", "risky_weather_overspeed")


@query("ignored_alerts", using("missed", """SELECT id, device AS "deviceId", target AS target_speed, speed FROM missed"""))
def ignored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = m.ignored_alerts(ev.alerts(spark, sf_dir), ev.gps(spark, sf_dir), DAY)
    return rows.select("id", "deviceId", "target_speed", "speed")


def card(spark: SparkSession, sf_dir: str) -> DataFrame:
    gps, limits = gps_and_limits(spark, sf_dir)
    return m.driver_scorecard(gps, limits, ev.weather(spark, sf_dir), ev.alerts(spark, sf_dir), **WIDE, horizon=DAY)


@query("driver_scorecard", using("classed", "SELECT * FROM classed"))
def driver_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_rows(card(spark, sf_dir), "risky_weather_overspeed", "ignored_alerts", "rating", "class")


@query("safety_rating", using("card", 'SELECT "deviceId", period, rating FROM card'))
def safety_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card(spark, sf_dir).select("deviceId", "period", "rating")


@query("rating_class", using("classed", "SELECT class, count(*) AS periods, min(rating) AS lowest, max(rating) AS highest FROM classed GROUP BY class"))
def rating_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card(spark, sf_dir).groupBy("class").agg(
        F.count(F.lit(1)).alias("periods"), F.min("rating").alias("lowest"), F.max("rating").alias("highest")
    )


FEEDBACK_SQL = """SELECT "deviceId", period,
    concat_ws('; ', CASE WHEN overspeed_events = 0 THEN 'Keeps to the speed limit' END,
      CASE WHEN risky_weather_overspeed = 0 THEN 'Careful in bad weather' END, CASE WHEN ignored_alerts = 0 THEN 'Follows advice' END) AS strengths,
    concat_ws('; ', CASE WHEN overspeed_events > 0 THEN 'Exceeds the speed limit' END,
      CASE WHEN max_speed_over_limit >= 30 THEN 'Extreme speeding' END, CASE WHEN risky_weather_overspeed > 0 THEN 'Speeds in bad weather' END,
      CASE WHEN ignored_alerts >= 2 THEN 'Ignores alerts' END) AS weaknesses,
    concat_ws('|', CASE WHEN overspeed_events > 0 THEN 'Watch the posted limit' END,
      CASE WHEN max_speed_over_limit >= 30 THEN 'Brake early before slower zones' END,
      CASE WHEN risky_weather_overspeed > 0 THEN 'Drive slower in rain, fog and snow' END,
      CASE WHEN ignored_alerts >= 2 THEN 'React to the first alert' END) AS improvement_tips{more} FROM classed"""


@query("rating_feedback", using("classed", FEEDBACK_SQL.format(more="")))
def rating_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return card(spark, sf_dir).select("deviceId", "period", "strengths", "weaknesses", F.array_join("improvement_tips", "|").alias("improvement_tips"))


@query("evaluations_json_sink", using("classed", FEEDBACK_SQL.format(more=", rating, class, \"deviceId\" AS key")))
def evaluations_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluations written as keyed JSON messages, read back and parsed."""
    folder = work_folder(spark, "evaluations")
    issued = m.evaluations(card(spark, sf_dir), F.timestamp_seconds(F.lit(0)))
    writers.to_messages(issued, "deviceId").write.parquet(folder)
    read = spark.read.schema("key string, value string").parquet(folder)
    rows = read.select("key", F.from_json("value", s.MESSAGES[s.EVALUATIONS_TOPIC]).alias("e")).select("key", "e.*")
    return rows.select("key", "deviceId", "period", "rating", "class", "strengths", "weaknesses",
                       F.array_join("improvement_tips", "|").alias("improvement_tips"))


@query("training_export", using("classed", """SELECT "deviceId", period, rating, class, overspeed_events, risky_weather_overspeed,
    ignored_alerts, left(period, 10) AS event_date FROM classed"""))
def training_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "training")
    rows = card(spark, sf_dir).withColumn("event_date", F.to_date(F.substring("period", 1, 10)))
    writers.write_partitioned(rows, folder, "event_date")
    return spark.read.parquet(folder).select(
        "deviceId", "period", "rating", "class", "overspeed_events", "risky_weather_overspeed", "ignored_alerts",
        F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
    )


@query("active_incident_flag", using("gps emergency", """SELECT g.id, coalesce(e.status = 'Active' AND e.kind <> 'None', false) AS active_incident
    FROM gps g ASOF LEFT JOIN emergency e ON g.device = e.device AND g.ts >= e.ts"""))
def active_incident_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = joins.as_of(ev.gps(spark, sf_dir), ev.emergency(spark, sf_dir), ["deviceId"], F.col("event_time"), ["type", "status"], ["id"])
    return rows.select("id", state.has_active_incident(F.col("type"), F.col("status")).alias("active_incident"))


@query("all_streams_joined", using("gps vehicles traffic weather emergency lim", """SELECT g.id, g.device AS "deviceId", g.speed, l.lim AS "SpeedLimit",
    v.make, t.camera AS "cameraID", w.label AS "weatherCondition", e.kind AS type, e.status FROM gps g
    ASOF LEFT JOIN vehicles v ON g.device = v.device AND g.ts >= v.ts ASOF LEFT JOIN traffic t ON g.device = t.device AND g.ts >= t.ts
    ASOF LEFT JOIN weather w ON g.device = w.device AND g.ts >= w.ts ASOF LEFT JOIN emergency e ON g.device = e.device AND g.ts >= e.ts
    ASOF LEFT JOIN lim l ON g.device = l.device AND g.ts >= l.ts"""))
def all_streams_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = {
        "vehicle": (ev.vehicles(spark, sf_dir), ["make"]),
        "traffic": (ev.traffic(spark, sf_dir), ["cameraID"]),
        "weather": (ev.weather(spark, sf_dir), ["weatherCondition"]),
        "emergency": (ev.emergency(spark, sf_dir), ["type", "status"]),
        "limit": (ev.limits(spark, sf_dir), ["SpeedLimit"]),
    }
    rows = joins.as_of_many(ev.gps(spark, sf_dir), sides, ["deviceId"], F.col("event_time"), ["id"])
    return rows.select("id", "deviceId", "speed", "limit.SpeedLimit", "vehicle.make", "traffic.cameraID",
                       "weather.weatherCondition", "emergency.type", "emergency.status")


# --- state and advice ---------------------------------------------------------------------------------------------

VEHICLE = ["make", "model", "year", "auto_braking_supported", "abs_supported", "traction_control_supported"]


def topic_rows(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [
        state.tagged(s.GPS_TOPIC, ev.gps(spark, sf_dir), ["speed"]),
        state.tagged(s.ROUTES_TOPIC, ev.limits(spark, sf_dir), ["SpeedLimit"]),
        state.tagged(s.WEATHER_TOPIC, ev.weather(spark, sf_dir), ["weatherCondition"]),
        state.tagged(s.EMERGENCY_TOPIC, ev.emergency(spark, sf_dir), ["type", "status"]),
        state.tagged(s.TRAFFIC_TOPIC, ev.traffic(spark, sf_dir), []),
        state.tagged(s.VEHICLE_TOPIC, ev.vehicles(spark, sf_dir), VEHICLE),
    ]


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.device_state(topic_rows(spark, sf_dir)).withColumn("road", rules.road_condition(F.col("weatherCondition")))


@query("device_state", using("state", """SELECT id, topic, device AS "deviceId", speed, lim AS "SpeedLimit", label AS "weatherCondition",
    kind AS type, status, make, model, year, auto_braking AS auto_braking_supported, abs_system AS abs_supported,
    traction AS traction_control_supported FROM state"""))
def device_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states(spark, sf_dir).select("id", "topic", "deviceId", "speed", "SpeedLimit", "weatherCondition", "type", "status", *VEHICLE)


@query("advice_prompt", using("advised", """SELECT id, topic, 'The vehicle is a ' || coalesce(CAST(year AS VARCHAR), 'unknown') || ' ' ||
    coalesce(make, 'unknown') || ' ' || coalesce(model, 'unknown') || '. ' ||
    CASE WHEN auto_braking THEN 'It supports auto-braking. ' ELSE 'It does not support auto-braking. ' END ||
    CASE WHEN abs_system THEN 'It has ABS braking system. ' ELSE 'It does not have ABS braking system. ' END ||
    CASE WHEN traction THEN 'It has traction control system. ' ELSE 'It does not have traction control system. ' END ||
    'The car is moving at ' || coalesce(CAST(round(speed, 2) AS VARCHAR), '0') || ' km/h where the speed limit is ' ||
    coalesce(CAST(round(lim, 2) AS VARCHAR), '90') || ' km/h. Weather is ' || coalesce(label, 'Clear sky') ||
    ', and road condition is ' || road || """ + "'. " + " ".join(g.replace("'", "''") for g in text.GUIDANCE) + "' AS prompt FROM advised"))
def advice_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = text.advice_prompt(*[F.col(c) for c in ("speed", "SpeedLimit", *VEHICLE, "weatherCondition", "road")])
    return states(spark, sf_dir).select("id", "topic", prompt.alias("prompt"))


ADVICE_SQL = """, x AS (SELECT *, coalesce(speed, 0) AS sp, coalesce(lim, 90) AS li,
      regexp_matches(lower(coalesce(label, 'Clear sky')), 'fog|rain|drizzle|snow|ice|thunder|hail') OR road <> 'Normal' OR incident AS risky,
      coalesce(label, 'Clear sky') IN ('Clear sky', 'Mainly clear') AND road = 'Normal' AND coalesce(auto_braking AND abs_system AND traction, false) AS fine
      FROM {source}),
    y AS (SELECT *, sp >= li - 5 AS near_limit, sp <= li - 20 AND fine AS faster FROM x)
    SELECT {columns}, CASE WHEN risky OR near_limit THEN 'slow_down' WHEN faster THEN 'speed_up' ELSE 'maintain_speed' END AS action,
      CASE WHEN risky OR near_limit THEN least(li - 10, sp) WHEN faster THEN least(sp + 10, li - 5) ELSE sp END AS target_speed,
      CASE WHEN risky THEN 'risky conditions' WHEN near_limit THEN 'close to the limit' WHEN faster THEN 'excellent conditions'
        ELSE 'steady conditions' END AS reason FROM y"""


@query("rule_advice", using("advised", ADVICE_SQL.format(source="advised", columns="id, topic")))
def rule_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = states(spark, sf_dir)
    incident = state.has_active_incident(F.col("type"), F.col("status"))
    advice = rules.rule_advice(F.col("speed"), F.col("SpeedLimit"), F.col("weatherCondition"), F.col("road"), incident,
                               F.col("auto_braking_supported"), F.col("abs_supported"), F.col("traction_control_supported"))
    return rows.select("id", "topic", advice.alias("a")).select("id", "topic", "a.*")


# --- batches, prompts and answers ---------------------------------------------------------------------------------

BATCHES_SQL = """, ordered AS (SELECT *, row_number() OVER (ORDER BY period, "deviceId") - 1 AS n FROM metrics),
    batched AS (SELECT *, n // 3 AS batch_id, CAST(n % 3 AS INT) AS index FROM ordered)"""


def using_batches(select: str) -> str:
    return using("metrics", BATCHES_SQL + " " + select)


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrival = F.unix_micros(F.try_to_timestamp(F.substring("period", 1, 19)))
    return windows.metrics_batches(wide_metrics(spark, sf_dir), arrival, ["deviceId"], 3)


@query("metrics_batches", using_batches('SELECT batch_id, index, "deviceId", period, overspeed_events FROM batched'))
def metrics_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batched(spark, sf_dir).select("batch_id", "index", "deviceId", "period", "overspeed_events")


@query("first_n_batches", using_batches("""SELECT batch_id, string_agg("deviceId" || '@' || period, ',' ORDER BY index) AS content
    FROM batched GROUP BY batch_id HAVING count(*) = 3 ORDER BY batch_id LIMIT 5"""))
def first_n_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = windows.first_batches(windows.full_batches(batched(spark, sf_dir), 3, ["deviceId", "period"]), 5)
    content = F.array_join(F.transform("batch", lambda x: F.concat(x["deviceId"], F.lit("@"), x["period"])), ",")
    return first.select("batch_id", content.alias("content"))


def rules_sql() -> str:
    return "'" + text.SCORING_RULES.replace("'", "''") + "'"


@query("scoring_prompt", using_batches(f"""SELECT batch_id, {rules_sql()} || string_agg('[' || index || ']:' || chr(10) || '{{' || chr(10) ||
      '  "deviceId": "' || "deviceId" || '",' || chr(10) || '  "period": "' || period || '",' || chr(10) ||
      '  "avg_speed_over_limit": ' || round(avg_speed_over_limit, 3) || ',' || chr(10) ||
      '  "overspeed_events": ' || overspeed_events || ',' || chr(10) ||
      '  "max_speed_over_limit": ' || round(max_speed_over_limit, 2) || chr(10) || '}}' || chr(10) || chr(10), '' ORDER BY index) AS prompt
    FROM batched GROUP BY batch_id HAVING count(*) = 3"""))
def scoring_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole metric goes into the request; averages and maxima without the noise of their last digits."""
    digits = {"avg_speed_over_limit": 3, "max_speed_over_limit": 2}
    entry = text.pretty_json({c: F.round(F.col(c), digits[c]) if c in digits else F.col(c) for c in METRIC})
    rows = batched(spark, sf_dir).withColumn("entry", entry)
    full = windows.full_batches(rows, 3, ["entry"])
    return full.select("batch_id", text.scoring_prompt(F.transform("batch", lambda x: x["entry"])).alias("prompt"))


@query("parse_evaluations", using_batches("""SELECT batch_id, index, CAST(least(overspeed_events, 100) AS INT) AS rating, "deviceId", period
      FROM batched WHERE batch_id IN (SELECT batch_id FROM batched GROUP BY ALL HAVING count(*) = 3)
    UNION ALL SELECT batch_id, -1, 7, "deviceId", period FROM batched
      WHERE index = 2 AND batch_id % 2 = 1 AND batch_id IN (SELECT batch_id FROM batched GROUP BY ALL HAVING count(*) = 3)"""))
def parse_evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with one item per metric and a last item that counts from the end; every other answer has an index outside
    the batch before it, which ends the list."""
    full = windows.full_batches(batched(spark, sf_dir), 3, ["deviceId", "period", "overspeed_events"])
    item = '{{"index": {0}, "rating": {1}, "class": "Fair", "strengths": "", "weaknesses": "", "improvement_tips": ["a", "b"]}}'
    items = F.transform("batch", lambda x: F.concat(
        F.lit('{"index": '), x["index"].cast("string"), F.lit(', "rating": '),
        F.least(x["overspeed_events"], F.lit(100)).cast("string"), F.lit(', "class": "Fair", "improvement_tips": ["a", "b"]}'),
    ))
    outside = F.when(F.col("batch_id") % 2 == 0, F.array(F.lit(item.format(3, 1)))).otherwise(F.array().cast("array<string>"))
    listed = F.array_join(F.concat(items, outside, F.array(F.lit(item.format(-1, 7)))), ",\n")
    answers = full.withColumn("answer", F.concat(F.lit("```JSON\n["), listed, F.lit("]\n```")))
    return text.parse_evaluations(answers, "answer", "batch").select("batch_id", "index", "rating", "deviceId", "period")


# --- text and answers ---------------------------------------------------------------------------------------------


@query("strip_code_fence", """SELECT conv_id, turn, regexp_replace(regexp_replace(text, '```(json)?', '', 'gi'),
    '^[\\s\\x0B\\x1c-\\x1f\\x{85}\\p{Z}]+|[\\s\\x0B\\x1c-\\x1f\\x{85}\\p{Z}]+$', '', 'g') AS answer FROM conversations""")
def strip_code_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    fenced = F.concat(F.lit(" ```JSON\n"), F.col("text"), F.lit("\n```  \n"))
    return ev.table(spark, sf_dir, "conversations").select("conv_id", "turn", text.strip_code_fence(fenced).alias("answer"))


@query("clean_advice_text", """SELECT doc_id, regexp_replace(replace(replace(replace(replace(text, '```json', ''), '```', ''), 'json' || chr(10), ''), 'json', ''),
    '^[\\s\\x0B\\x1c-\\x1f\\x{85}\\p{Z}]+|[\\s\\x0B\\x1c-\\x1f\\x{85}\\p{Z}]+$', '', 'g') AS answer FROM documents""")
def clean_advice_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts wrapped as an answer; the word goes everywhere, inside the text too."""
    fenced = F.concat(F.lit("  ```json\njson\n"), F.col("text"), F.lit("json\n```  "))
    return ev.table(spark, sf_dir, "documents").select("doc_id", text.clean_advice_text(fenced).alias("answer"))


@query("parse_advice", using("alerts", """SELECT id, CASE id % 5 WHEN 4 THEN 'fleet' ELSE device END AS "deviceId",
    CASE WHEN id % 5 IN (1, 2) THEN NULL ELSE action END AS action, CASE WHEN id % 5 IN (2, 3) THEN NULL ELSE target END AS target_speed,
    CASE id % 5 WHEN 1 THEN 'action' WHEN 2 THEN 'malformed' WHEN 3 THEN 'target_speed' END AS reject_reason, ms AS ts FROM alerts"""))
def parse_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fenced answers, answers without action or target, text that is no JSON, and an answer that names its own device."""
    body = F.to_json(F.struct(
        F.when(F.col("id") % 5 != 1, F.col("action")).alias("action"),
        F.when(F.col("id") % 5 != 3, F.col("target_speed")).alias("target_speed"),
        F.lit("see json").alias("reason"), F.when(F.col("id") % 5 == 4, "fleet").alias("deviceId"), F.lit(0).alias("ts"),
    ))
    answer = F.when(F.col("id") % 5 == 2, "Slow down, please.").otherwise(F.concat(F.lit("```json\n"), body, F.lit("\n```")))
    rows = ev.alerts(spark, sf_dir).select("id", F.col("deviceId").alias("device"), "event_time", answer.alias("answer"))
    return text.parse_advice(rows, "answer", "device", F.col("event_time")).select(
        "id", "deviceId", "action", "target_speed", "reject_reason", "ts"
    )
