"""Structured Streaming twins, replayed from files of topic messages."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside import schemas as s
from kerbside.operators import joins, metrics as m, state
from kerbside.operators.timeline import union_all
from kerbside.plans import jobs
from kerbside.plans.analysis import ADVICE_SQL, METRIC, PAIR_SQL, metric_rows, settled
from kerbside.plans.catalogue import WIDE, query
from kerbside.plans.ingest import TOPIC_COLUMNS, TOPIC_SQL, number
from kerbside.plans.sequences import DEDUPE_SQL, THROTTLE_SQL
from kerbside.plans.sql_views import ISO, SEC, using
from kerbside.session import work_folder
from kerbside.sinks import writers
from kerbside.sources import event_views as ev, topics
from kerbside.sources.envelope import iso_time, to_envelope
from kerbside.streaming import run, stateful


def gps_stream(log: DataFrame) -> DataFrame:
    return topics.topic_stream(log, s.GPS_TOPIC)


def limit_stream(log: DataFrame) -> DataFrame:
    return topics.speed_limit_stream(log, s.ROUTES_TOPIC)


def position_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.gps_messages(spark, sf_dir).unionByName(ev.limit_messages(spark, sf_dir))


def with_closer(log: DataFrame, after: str = "5 days") -> list[DataFrame]:
    return [log, run.closers(log, after)]


@query("stream_overspeed_metrics", using("metrics", "SELECT * FROM metrics"))
def stream_overspeed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run.replay(
        spark, "overspeed", with_closer(position_log(spark, sf_dir)),
        lambda log: m.overspeed_metrics_stream(gps_stream(log), limit_stream(log), **WIDE),
    )
    return metric_rows(rows)


@query("metrics_json_sink", using("metrics", "SELECT * FROM metrics"))
def metrics_json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the stream as keyless JSON messages, read back and parsed."""
    rows = run.replay(
        spark, "metrics-sink", with_closer(position_log(spark, sf_dir)),
        lambda log: writers.to_messages(m.overspeed_metrics_stream(gps_stream(log), limit_stream(log), **WIDE)),
    )
    parsed = rows.select(F.from_json("value", s.MESSAGES[s.METRICS_TOPIC]).alias("m")).select("m.*")
    return metric_rows(parsed.select(*METRIC))


@query("stream_gps_limits", using("gps lim", """SELECT id, "deviceId", speed, limit_id % 97 AS place, "SpeedLimit" FROM (""" + PAIR_SQL.format(how="LEFT") + ")"))
def stream_gps_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run.replay(
        spark, "interval-join", with_closer(position_log(spark, sf_dir)),
        lambda log: joins.interval_join(gps_stream(log), limit_stream(log), "1 day", "left"),
    ).where("deviceId <> 'closer'")  # not inside the stream: the filter would be pushed below the watermark
    return rows.select(number("id"), "deviceId", "speed", F.col("placeId").cast("bigint").alias("place"), "SpeedLimit")


def day_counts(rows: DataFrame) -> DataFrame:
    counts = rows.groupBy(F.window("event_time", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("messages"))
    return counts.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "messages")


@query("stream_watermark_late", """SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, count(*) AS messages FROM events,
    (SELECT max(ts) - INTERVAL 10 SECOND AS mark FROM events WHERE event_type IN ('click', 'view', 'signup'))
    WHERE event_type IN ('click', 'view', 'signup') OR time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY > mark GROUP BY day""")
def stream_watermark_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other events follow in a second batch, when the watermark has passed all days but the last: those rows are
    late and must not be counted."""
    others = ev.table(spark, sf_dir, "events").where(~F.col("event_type").isin(ev.GPS_TYPES)).select(
        F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("deviceId"),
        F.col("ts").cast("timestamp").alias("event_time"), F.col("value").alias("speed"),
    ).withColumn("timestamp", iso_time(F.col("event_time")))
    late = to_envelope(others, s.GPS_TOPIC, "id", "event_time", ["id", "deviceId", "timestamp", "speed"], "id")
    log = ev.gps_messages(spark, sf_dir)
    return run.replay(spark, "late", [log, late, run.closers(log, "5 days")], lambda x: day_counts(gps_stream(x)))


@query("stream_trip_summary", using("gps over", """, pairs AS (SELECT id, count(*) AS n FROM over GROUP BY id),
    flagged AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 12 HOUR THEN 1 ELSE 0 END AS s
      FROM gps WINDOW w AS (PARTITION BY device ORDER BY ts, id)),
    tripped AS (SELECT *, sum(s) OVER (PARTITION BY device ORDER BY ts, id) AS trip FROM flagged)
    SELECT device AS "deviceId", strftime(min(ts), """ + ISO + """) AS trip_start, strftime(max(ts), """ + ISO + """) AS trip_end, count(*) AS fixes,
      (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS duration_s, round(sum(speed), 2) / count(*) AS avg_speed, max(speed) AS max_speed,
      CAST(coalesce(sum(n), 0) AS BIGINT) AS overspeed_events FROM tripped LEFT JOIN pairs USING (id) GROUP BY device, trip"""))
def stream_trip_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run.replay(spark, "trips", [*halves(position_log(spark, sf_dir)), run.closers(position_log(spark, sf_dir), "5 days")],
                      lambda x: m.trip_summary_stream(gps_stream(x), "12 hours", limit_stream(x), "1 day"))
    return rows.where("deviceId <> 'closer'").select(
        "deviceId", iso_time(F.col("trip_start")).alias("trip_start"), iso_time(F.col("trip_end")).alias("trip_end"), "duration_s", "fixes",
        settled("avg_speed", "fixes"), "max_speed", "overspeed_events",
    )


def halves(log: DataFrame) -> list[DataFrame]:
    """Two stages in time order, split half-way between the first and the last message: state has to survive the restart."""
    first, last = log.agg(F.unix_micros(F.min("timestamp")), F.unix_micros(F.max("timestamp"))).first()
    middle = F.timestamp_micros(F.lit(((first or 0) + (last or 0)) // 2))
    return [log.where(F.col("timestamp") < middle), log.where(F.col("timestamp") >= middle)]


@query("stream_advice_throttle", THROTTLE_SQL)
def stream_advice_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ev.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("deviceId"), F.col("ts").cast("timestamp").alias("event_time")
    ).withColumn("timestamp", iso_time(F.col("event_time")))
    log = to_envelope(rows, s.GPS_TOPIC, "id", "event_time", ["id", "deviceId", "timestamp"], "id")
    done = run.replay(spark, "throttle", halves(log), lambda x: stateful.throttle_stream(
        gps_stream(x).withColumn("id", F.col("id").cast("bigint")), "1 day"))
    return done.select("id", "deviceId", "emitted")


def numbered_alerts(log: DataFrame) -> DataFrame:
    """Alerts carry no id of their own; the message offset is one."""
    rows = topics.parse_messages(log.where(F.col("topic") == s.ALERTS_TOPIC), s.MESSAGES[s.ALERTS_TOPIC], keep=["offset"])
    return topics.good(rows).withColumnRenamed("offset", "id")


@query("stream_alert_dedupe", using("alerts", DEDUPE_SQL))
def stream_alert_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ev.alert_messages(spark, sf_dir)
    done = run.replay(spark, "dedupe", halves(log), lambda x: stateful.alert_dedupe_stream(numbered_alerts(x)))
    return done.select("id", "deviceId", "action", "target_speed", "suppressed")


@query("stream_alerts_sink", using("alerts", f"""SELECT "deviceId" AS key, "deviceId", d.action, d.target_speed, a.reason
    FROM ({DEDUPE_SQL}) d JOIN alerts a ON d.id = a.id WHERE NOT d.suppressed"""))
def stream_alerts_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the alert topic gets: the whole advice, reason and all, unless it is a near-duplicate."""
    log = ev.alert_messages(spark, sf_dir)
    fields = ["deviceId", "action", "target_speed", "reason"]
    done = run.replay(spark, "alerts-sink", halves(log), lambda x: writers.to_messages(
        stateful.alert_dedupe_stream(numbered_alerts(x)).where(~F.col("suppressed")), "deviceId", fields))
    return done.select("key", F.from_json("value", s.MESSAGES[s.ALERTS_TOPIC]).alias("a")).select("key", *[f"a.{c}" for c in fields])


@query("stream_route_count_window", using("windows", """SELECT window_no, device AS "deviceId", id, array_to_string(ids, ',') AS fix_ids FROM windows"""))
def stream_route_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ev.gps_messages(spark, sf_dir)
    done = run.replay(spark, "count-window", halves(log), lambda x: stateful.count_windows_stream(
        gps_stream(x).withColumn("id", F.col("id").cast("bigint"))))
    return done.select("window_no", "deviceId", "id", F.array_join("fix_ids", ",").alias("fix_ids"))


@query("stream_route_cache", using("lim", f"""SELECT 'route:' || place AS key, arg_max(CAST(lim AS VARCHAR), (ts, id)) AS value,
    strftime(max(ts), {ISO}) AS written_at, strftime(max(ts) + INTERVAL 1 HOUR, {ISO}) AS expires_at FROM lim GROUP BY place"""))
def stream_route_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cache holds last: of the entries written per micro-batch, the newest of each key."""
    def writes(log: DataFrame) -> DataFrame:
        rows = topics.parse_messages(log.where(F.col("topic") == s.ROUTES_TOPIC), s.MESSAGES[s.ROUTES_TOPIC], keep=["offset"])
        return stateful.cache_write_stream(topics.good(rows).withWatermark("event_time", "30 seconds").select(
            F.concat(F.lit("route:"), "placeId").alias("key"), F.col("SpeedLimit").cast("string").alias("value"), "event_time",
            F.col("offset").alias("id"),
        ))

    done = run.replay(spark, "route-cache", halves(ev.limit_messages(spark, sf_dir)), writes)
    last = done.groupBy("key").agg(F.max(F.struct("event_time", "id", "value", "expires_at")).alias("e"))
    return last.select("key", "e.value", iso_time(F.col("e.event_time")).alias("written_at"), iso_time(F.col("e.expires_at")).alias("expires_at"))


STATE_TOPICS = [s.GPS_TOPIC, s.ROUTES_TOPIC, s.WEATHER_TOPIC, s.EMERGENCY_TOPIC, s.VEHICLE_TOPIC]


@query("stream_device_state", using("gps lim weather emergency vehicles", """, d AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS device FROM events)
    SELECT d.device AS "deviceId", (SELECT arg_max(speed, (ts, id)) FROM gps g WHERE g.device = d.device) AS speed,
      (SELECT arg_max(lim, (ts, id)) FROM lim l WHERE l.device = d.device) AS "SpeedLimit",
      (SELECT arg_max(label, (ts, id)) FROM weather w WHERE w.device = d.device) AS "weatherCondition",
      (SELECT arg_max(kind, (ts, id)) FROM emergency e WHERE e.device = d.device) AS type,
      (SELECT arg_max(status, (ts, id)) FROM emergency e WHERE e.device = d.device) AS status,
      (SELECT max(make) FROM vehicles v WHERE v.device = d.device) AS make FROM d"""))
def stream_device_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each micro-batch writes the devices it changed; the newest batch of a device holds its state."""
    log = union_all([ev.MESSAGES[t](spark, sf_dir) for t in STATE_TOPICS])
    changed = run.replay(
        spark, "device-state", halves(log),
        lambda x: state.latest_state(topics.multi_topic_stream(x, STATE_TOPICS)), mode="update",
    )
    columns = ["speed", "SpeedLimit", "weatherCondition", "type", "status", "make"]
    newest = changed.groupBy("deviceId").agg(F.max_by(F.struct(*columns), "batch_id").alias("s"))
    return newest.select("deviceId", "s.*")


def _register_archive(topic: str, view: str, columns: list[str], sql_columns: str) -> None:
    short = topic.removesuffix("_data")

    @query(f"archive_{short}", using(view, f"""SELECT id, device AS "deviceId", strftime(ts, {ISO}) AS event_time,
        strftime(ts, '%Y-%m-%d') AS event_date, {sql_columns} FROM {view}"""))
    def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = work_folder(spark, f"archive-{short}")
        ev.MESSAGES[topic](spark, sf_dir).write.parquet(f"{folder}/messages")
        log = spark.readStream.schema(topics.ENVELOPE).parquet(f"{folder}/messages")
        rows = topics.topic_stream(log, topic)
        started = writers.start_archive({topic: rows}, folder, availableNow=True)
        for running in started:
            running.awaitTermination()
        saved = spark.read.parquet(f"{folder}/data/{topic}")
        return saved.select(number("id"), "deviceId", iso_time(F.col("event_time")).alias("event_time"),
                            F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), *columns)


for _topic, _columns in TOPIC_COLUMNS.items():
    _register_archive(_topic, TOPIC_SQL[_topic][0], _columns, TOPIC_SQL[_topic][1])
_register_archive(s.GPS_TOPIC, "gps", ["speed", "direction", "vehicle_type"], "speed, 'North-East' AS direction, 'private' AS vehicle_type")


ARCHIVED = {s.VEHICLE_TOPIC: "vehicles", s.GPS_TOPIC: "gps", s.TRAFFIC_TOPIC: "traffic", s.WEATHER_TOPIC: "weather", s.EMERGENCY_TOPIC: "emergency"}


@query("archive_all", using(" ".join(ARCHIVED.values()), " UNION ALL ".join(
    f"SELECT '{t}' AS topic, strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS messages FROM {v} GROUP BY ALL" for t, v in ARCHIVED.items())))
def archive_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five archive queries running at the same time, from topics in a folder."""
    folder = work_folder(spark, "archive-all")
    for topic in ARCHIVED:
        ev.MESSAGES[topic](spark, sf_dir).write.parquet(f"{folder}/topics/{topic}")
    at = jobs.Topics(spark, f"{folder}/checkpoints", folder=f"{folder}/topics")
    run.run_all(spark, jobs.archive_job(at, f"{folder}/archive"), availableNow=True)
    return union_all([
        spark.read.parquet(f"{folder}/archive/{topic}").groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("messages")).select(F.lit(topic).alias("topic"), "event_date", "messages") for topic in ARCHIVED
    ])


def _stream_advice_sql() -> str:
    latest = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in "speed lim label kind status auto_braking abs_system traction".split()
    )
    steps = f""",
    m AS (SELECT *, CASE topic WHEN 'optimized_routes' THEN '' ELSE CAST(id AS VARCHAR) END AS sid FROM messages),
    s AS (SELECT device, ts, row_number() OVER (PARTITION BY device, ts ORDER BY sid, topic) AS place, {latest} FROM m
      WINDOW w AS (PARTITION BY device ORDER BY ts, sid, topic ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    d AS (SELECT DISTINCT device, ts FROM m),
    f AS (SELECT a.device, a.ts, min(b.ts) AS following FROM d a JOIN d b ON a.device = b.device AND b.ts >= a.ts + INTERVAL 1 DAY GROUP BY ALL),
    chain AS (SELECT device, min(ts) AS ts FROM d GROUP BY device
      UNION ALL SELECT f.device, f.following FROM chain c JOIN f ON c.device = f.device AND c.ts = f.ts),
    sent AS (SELECT s.*, CASE label WHEN 'Fog' THEN 'Low-visibility' ELSE 'Normal' END AS road,
        coalesce(status = 'Active' AND kind <> 'None', false) AS incident
      FROM s JOIN chain c ON s.device = c.device AND s.ts = c.ts WHERE place = 1)"""
    advice = ADVICE_SQL.format(source="sent", columns='device AS "deviceId", epoch_us(ts) // 1000 AS ts')
    return using("messages", steps + advice).replace("WITH ", "WITH RECURSIVE ", 1)


@query("stream_assistant_advice", _stream_advice_sql())
def stream_assistant_advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topics -> device state -> throttle -> advice, with a restart in the middle."""
    log = union_all([ev.MESSAGES[t](spark, sf_dir) for t in jobs.ASSISTANT_TOPICS])
    return run.replay(spark, "advice", halves(log), lambda x: jobs.advice_rows(x, "1 day").drop("prompt"))


def scorecard_stages(log: DataFrame) -> list[DataFrame]:
    """The log in two halves, then records of an extra device, twice: what settles the first of them closes the windows before."""
    end = log.agg(F.max("timestamp").alias("end"))
    stages = halves(log)
    for days in (5, 10):
        rows = end.select((F.col("end") + F.expr(f"INTERVAL {days} days")).alias("event_time"), F.lit("closer").alias("deviceId"),
                          F.lit("slow_down").alias("action"), F.lit(1000.0).alias("target_speed"))
        alert = to_envelope(rows.withColumn("ts", F.unix_millis("event_time")), s.ALERTS_TOPIC, "deviceId", "event_time",
                            ["deviceId", "action", "target_speed", "ts"])
        stages.append(run.closers(log, f"{days} days").unionByName(alert))
    return stages


def published_scorecards(spark: SparkSession, stages: list[DataFrame], **settings: str) -> DataFrame:
    """Evaluations that the scorecard job publishes as the stages come in; every stage resumes from the checkpoints."""
    folder = work_folder(spark, "scorecard")
    for stage in stages:
        for topic in (s.GPS_TOPIC, s.WEATHER_TOPIC, s.ALERTS_TOPIC, s.ROUTES_TOPIC):
            stage.where(F.col("topic") == topic).write.mode("append").parquet(f"{folder}/topics/{topic}")
        at = jobs.Topics(spark, f"{folder}/checkpoints", folder=f"{folder}/topics")
        *settle, rate = jobs.scorecard_job(at, f"{folder}/settled", **settings)
        run.run_all(spark, settle, availableNow=True)
        run.run_all(spark, [rate], availableNow=True)
    fields = "deviceId string, period string, avg_speed_over_limit double, overspeed_events long, max_speed_over_limit double, " \
        "risky_weather_overspeed long, ignored_alerts long, rating int, class string"
    sent = spark.read.schema("key string, value string").parquet(f"{folder}/topics/{s.EVALUATIONS_TOPIC}")
    return sent.select(F.from_json("value", fields).alias("m")).select("m.*").where("deviceId <> 'closer'")


@query("stream_driver_scorecard", using("classed", "SELECT * FROM classed"))
def stream_driver_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = union_all([ev.MESSAGES[t](spark, sf_dir) for t in (s.GPS_TOPIC, s.ROUTES_TOPIC, s.WEATHER_TOPIC, s.ALERTS_TOPIC)])
    cards = published_scorecards(spark, scorecard_stages(log), **WIDE, horizon="1 day")
    return metric_rows(cards, "risky_weather_overspeed", "ignored_alerts", "rating", "class")


@query("stream_join_state", using("gps lim", """, mark AS (SELECT time_bucket(INTERVAL 1 MILLISECOND, least((SELECT max(ts) FROM gps) - INTERVAL 10 SECOND, (SELECT max(ts) FROM lim) - INTERVAL 30 SECOND))
      - INTERVAL 1 DAY AS mark),
    rows AS (SELECT 'left' AS side, ts FROM gps UNION ALL SELECT 'right', ts FROM lim)
    SELECT side, count(*) AS kept, count(*) FILTER (ts > mark) AS after_eviction FROM rows, mark GROUP BY side"""))
def stream_join_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the interval join holds after its first batch, and after the watermark has let it forget; a limit that it holds
    in two stretches of time counts once."""
    folder = work_folder(spark, "join-state")
    position_log(spark, sf_dir).write.parquet(f"{folder}/messages")
    log = spark.readStream.schema(topics.ENVELOPE).parquet(f"{folder}/messages")
    joined = joins.interval_join(gps_stream(log), limit_stream(log), "1 day", "left")
    run.run_available(spark, joined.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint"))
    once = joins.held_once("1 day")
    first, last = (run.join_state(spark, f"{folder}/checkpoint", b, right_where=once).groupBy("side").agg(F.count("*").alias(name))
                   for b, name in ((0, "kept"), (None, "after_eviction")))
    return first.join(last, "side", "left").select("side", "kept", F.coalesce("after_eviction", F.lit(0)).alias("after_eviction"))


@query("stream_written_once", """SELECT event_id AS id, CAST(user_id AS VARCHAR) AS key FROM events WHERE event_type IN ('click', 'view', 'signup')""")
def stream_written_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fix is delivered twice and the write of the first batch fails half-way, so that it runs again."""
    folder = work_folder(spark, "once")
    for stage in halves(ev.gps_messages(spark, sf_dir)):
        stage.unionByName(stage).write.mode("append").parquet(f"{folder}/messages")
        log = spark.readStream.schema(topics.ENVELOPE).parquet(f"{folder}/messages")
        sent = topics.topic_rows(log, s.GPS_TOPIC).select("id", F.col("deviceId").alias("key"), "event_time")
        failed = []

        def fail_once(rows: DataFrame, batch_id: int) -> None:
            if batch_id == 0 and not failed:
                failed.append(batch_id)
                rows.limit(1).write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")
                raise RuntimeError("lost")

        for attempt in (fail_once, None):
            writer = writers.once_writer(sent, f"{folder}/out", f"{folder}/checkpoint", ["id", "key"], "1 day", attempt)
            try:
                run.run_available(spark, writer)
            except StreamingQueryException:
                if not failed:
                    raise
    return spark.read.parquet(f"{folder}/out").select(number("id"), "key")
