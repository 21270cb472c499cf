"""The running jobs: metrics, archive, routes, assistant and evaluator, each on topics in Kafka or in a folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from kerbside import schemas as s
from kerbside.functions import rules, text
from kerbside.operators import metrics as m, routes, state
from kerbside.operators.cache import TIME_TO_LIVE
from kerbside.operators.cache_table import CacheTable
from kerbside.operators.joins import interval_join
from kerbside.operators.retrieval import TOP_K, requests_with_context
from kerbside.operators.vector_index import VectorIndex
from kerbside.sinks import writers
from kerbside.sources import topics
from kerbside.streaming import asof, stateful

#: Advice before near-duplicates are dropped; the second half of the assistant reads it.
ADVICE_TOPIC = "driver_advice"
#: A device silent for so long starts afresh, so that state does not grow with every device there ever was; and how late
#: a message may be.
FORGET, LATE = "30 days", "1 day"
ASSISTANT_TOPICS = [s.GPS_TOPIC, s.WEATHER_TOPIC, s.TRAFFIC_TOPIC, s.EMERGENCY_TOPIC, s.ROUTES_TOPIC, s.VEHICLE_TOPIC]


@dataclass(frozen=True)
class Topics:
    """Where the topics are (``bootstrap`` servers, or a ``folder`` with one sub-folder per topic) and where checkpoints go.

    ``per_trigger`` bounds what a micro-batch reads, in messages or, from a folder, in files: the first one would else be the
    whole backlog, and with it all a device has sent, in one call of a stateful operator.
    """

    spark: SparkSession
    checkpoints: str
    bootstrap: str | None = None
    folder: str | None = None
    per_trigger: int = 1_000_000

    def read(self, *names: str) -> DataFrame:
        if self.bootstrap:
            return topics.read_topics(self.spark, names, bootstrap=self.bootstrap, maxOffsetsPerTrigger=str(self.per_trigger))
        parts = ",".join(names)
        return topics.read_topics(self.spark, names, path=f"{self.folder}/{{{parts}}}", maxFilesPerTrigger=str(self.per_trigger))

    def write(self, rows: DataFrame, topic: str, key: str | None = None, fields: list[str] | None = None) -> DataStreamWriter:
        path = None if self.bootstrap else f"{self.folder}/{topic}"
        return writers.topic_writer(rows, topic, key=key, fields=fields, bootstrap=self.bootstrap, path=path,
                                    checkpoint=f"{self.checkpoints}/{topic}").queryName(topic)


def metrics_job(at: Topics, salts: int = 1, taps: bool = False) -> list[DataStreamWriter]:
    """Fixes and speed limits -> overspeed metrics per device and minute; with ``taps`` every step goes to the console too."""
    gps = topics.topic_stream(at.read(s.GPS_TOPIC), s.GPS_TOPIC).select("id", "deviceId", "speed", "timestamp", "event_time")
    limits = topics.speed_limit_stream(at.read(s.ROUTES_TOPIC), s.ROUTES_TOPIC)
    metrics = m.overspeed_metrics_stream(gps, limits, salts=salts)
    started = [at.write(metrics, s.METRICS_TOPIC)]
    if taps:
        joined = interval_join(gps, limits, salts=salts)
        over = joined.where(F.col("speed") > F.col("SpeedLimit"))
        steps = {"gps": gps, "speed limits": limits, "joined": joined, "filtered": over, "metrics": metrics}
        started += [writers.console_tap(rows, tag) for tag, rows in steps.items()]
    return started


def archive_job(at: Topics, folder: str) -> list[DataStreamWriter]:
    """Five topics as Parquet tables, one folder per day each."""
    names = [s.VEHICLE_TOPIC, s.GPS_TOPIC, s.TRAFFIC_TOPIC, s.WEATHER_TOPIC, s.EMERGENCY_TOPIC]
    return [
        writers.archive_writer(topics.topic_stream(at.read(t), t), f"{folder}/{t}", f"{at.checkpoints}/archive_{t}").queryName(f"archive_{t}")
        for t in names
    ]


def routes_job(at: Topics, roads: DataFrame, out: str, size: int = 3, posted: DataFrame | None = None,
               ttl: str = TIME_TO_LIVE) -> list[DataStreamWriter]:
    """Every ``size`` valid fixes of a device -> a road point with a limit, published as route messages.

    The point comes from the cache below ``out`` if the place has a live entry written by an earlier batch, else from the
    nearest road; what was snapped is cached (``CacheTable``). A batch that runs again sees the same entries and replaces its own. A second
    query publishes the routes, a third keeps messages that are no valid fixes below ``out``, with the reason.
    """
    spark = at.spark
    checked = topics.validate_gps(at.read(s.GPS_TOPIC))
    fixes = topics.valid_gps(checked).where(topics.has_two_coordinates(F.col("location")))
    windows = stateful.count_windows_stream(fixes.withColumn("id", F.xxhash64("id")).withWatermark("event_time", LATE), size, FORGET)
    cache = CacheTable(spark, f"{out}/cache", ttl, LATE)
    sent = "deviceID STRING, placeId STRING, timestamp STRING, SpeedLimit DOUBLE"
    spark.createDataFrame([], sent).write.mode("overwrite").parquet(f"{out}/routes/batch_id=-1")  # so that there is something to read

    def save(batch: DataFrame, batch_id: int) -> None:
        cache.compact(batch_id)
        earlier = cache.writes_before(batch_id, routes.cache_keys(batch))
        found = routes.cached_or_snapped(batch, roads, earlier, ttl).persist()
        messages = routes.route_messages(routes.with_limit(found, posted))
        messages.write.mode("overwrite").parquet(f"{out}/routes/batch_id={batch_id}")
        cache.write(routes.cache_writes(found.where("NOT cached")), batch_id)
        found.unpersist()

    routed = windows.writeStream.foreachBatch(save).option("checkpointLocation", f"{at.checkpoints}/routes").queryName("routes")
    table = spark.readStream.schema(f"{sent}, batch_id BIGINT").parquet(f"{out}/routes").drop("batch_id")
    published = at.write(table, s.ROUTES_TOPIC, "deviceID")
    rejected = topics.rejected_gps(checked).writeStream.format("parquet").option("path", f"{out}/rejected") \
        .option("checkpointLocation", f"{at.checkpoints}/routes_rejected").queryName("routes_rejected")
    return [routed, published, rejected]


def advice_rows(log: DataFrame, gap: str = "2 seconds") -> DataFrame:
    """Messages of all topics -> device state -> throttle -> advice, with the request text a model would get."""
    messages = topics.multi_topic_stream(log, ASSISTANT_TOPICS).where("event_time IS NOT NULL")
    named = messages.withColumn("id", F.coalesce("id", F.lit(""))).withWatermark("event_time", LATE)
    known = stateful.state_stream(named, state.STATE_TYPES, gap, FORGET)
    road = rules.road_condition(F.col("weatherCondition"))
    abilities = [F.col(c) for c in ("auto_braking_supported", "abs_supported", "traction_control_supported")]
    advice = rules.rule_advice(F.col("speed"), F.col("SpeedLimit"), F.col("weatherCondition"), road,
                               state.has_active_incident(F.col("type"), F.col("status")), *abilities)
    prompt = text.advice_prompt(F.col("speed"), F.col("SpeedLimit"), F.col("make"), F.col("model"), F.col("year"), *abilities,
                                F.col("weatherCondition"), road)
    return known.select("deviceId", advice.alias("a"), F.unix_millis("event_time").alias("ts"), prompt.alias("prompt")).select(
        "deviceId", "a.*", "ts", "prompt"
    )


def assistant_job(at: Topics, gap: str = "2 seconds") -> list[DataStreamWriter]:
    """State, throttle and advice in a first query; near-duplicates are dropped by a second one."""
    fields = ["deviceId", "action", "target_speed", "reason", "ts"]
    return [at.write(advice_rows(at.read(*ASSISTANT_TOPICS), gap), ADVICE_TOPIC, "deviceId", fields)]


def context_job(at: Topics, index: VectorIndex, chunks: DataFrame, out: str, k: int = TOP_K, gap: str = "2 seconds") -> list[DataStreamWriter]:
    """What a model would be asked for each piece of advice: the prompt behind the chunks (``vec_id``, ``chunk``) that the index
    finds nearest to it, per micro-batch below ``out``."""
    def save(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("query_id", F.xxhash64("deviceId", "ts", "prompt"))
        distinct = named.select("query_id", "prompt").distinct()
        asked = requests_with_context(distinct, chunks, lambda queries: index.search(queries, k))
        rows = named.join(asked.select("query_id", "request"), "query_id", "left").drop("query_id", "prompt")
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    advice = advice_rows(at.read(*ASSISTANT_TOPICS), gap)
    return [advice.writeStream.foreachBatch(save).option("checkpointLocation", f"{at.checkpoints}/requests").queryName("requests")]


def alerts_job(at: Topics) -> list[DataStreamWriter]:
    """Advice that is no near-duplicate of the device's last four."""
    log = at.read(ADVICE_TOPIC).withColumn("id", F.xxhash64("value"))
    rows = topics.good(topics.parse_messages(log, s.MESSAGES[s.ALERTS_TOPIC], keep=["id"]))
    done = stateful.alert_dedupe_stream(rows.withWatermark("event_time", LATE), forget=FORGET).where(~F.col("suppressed")).withColumn("ts", F.unix_millis("event_time"))
    return [at.write(done, s.ALERTS_TOPIC, "deviceId", ["deviceId", "action", "target_speed", "reason", "ts"])]


def scorecard_job(at: Topics, folder: str, tolerance: str = "5 minutes", window: str = "1 minute", horizon: str = "30 seconds",
                  late: str = "30 seconds", salts: int = 1) -> list[DataStreamWriter]:
    """Fixes, limits, weather and alerts -> rated scorecards per device and window, published as evaluations.

    Two queries settle what lies side by side in time, each fix's weather and each alert's next fix, and append it below ``folder``;
    the third joins the fixes with the limits, aggregates and rates. What the first two write comes in the order their watermark
    moved, so the third needs no slack for it beyond ``horizon``, by which an answered alert may come earlier than another.
    """
    gps = topics.topic_rows(at.read(s.GPS_TOPIC), s.GPS_TOPIC).select("id", "deviceId", "speed", "event_time")
    weather = topics.topic_rows(at.read(s.WEATHER_TOPIC), s.WEATHER_TOPIC).select("id", "deviceId", "weatherCondition", "event_time")
    alerts = topics.topic_rows(at.read(s.ALERTS_TOPIC), s.ALERTS_TOPIC).select("deviceId", "action", "target_speed", "event_time")
    settled = {
        "fixes": asof.as_of_stream(gps, weather, ["weatherCondition"], late=late, forget=FORGET),
        "answered": asof.as_of_stream(alerts.where("action = 'slow_down'"), gps, ["speed"], max_age=horizon, forward=True, late=late),
    }
    started, tables = [], {}
    for name, rows in settled.items():
        path = f"{folder}/{name}"
        at.spark.createDataFrame([], rows.schema).write.mode("append").parquet(path)  # so that there is something to read
        started.append(rows.writeStream.format("parquet").option("path", path)
                       .option("checkpointLocation", f"{at.checkpoints}/{name}").queryName(name))
        tables[name] = at.spark.readStream.schema(rows.schema).parquet(path)
    cards = m.driver_scorecard_stream(
        tables["fixes"].withWatermark("event_time", "0 seconds"), topics.speed_limit_stream(at.read(s.ROUTES_TOPIC), s.ROUTES_TOPIC),
        tables["answered"].withWatermark("event_time", horizon), tolerance, window, salts)
    published = m.evaluations(cards, F.current_timestamp())
    extra = [c for c in cards.columns if c not in published.columns]
    rows = cards.withColumns({"index": F.lit(0), "ts": F.unix_millis(F.current_timestamp())}).select(*published.columns, *extra)
    return [*started, at.write(rows, s.EVALUATIONS_TOPIC, "deviceId")]


def evaluator_job(at: Topics) -> list[DataStreamWriter]:
    """Metrics -> rating, class and feedback."""
    log = at.read(s.METRICS_TOPIC)
    rows = topics.good(topics.parse_messages(log, s.MESSAGES[s.METRICS_TOPIC])).drop("event_time")
    rated = m.evaluations(m.rate(rows), F.current_timestamp())
    return [at.write(rated, s.EVALUATIONS_TOPIC, "deviceId")]
