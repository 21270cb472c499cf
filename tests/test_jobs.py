"""The scripted journeys through all jobs, on topics in a folder."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside import schemas as s
from kerbside.plans import jobs
from kerbside.sources import topics
from kerbside.sources.documents import build_chunk_vectors
from kerbside.operators import routes
from kerbside.operators.cache_table import CacheTable
from kerbside.operators.vector_index import build_index
from kerbside.streaming.run import run_all, run_available

START = datetime(2024, 1, 1, 12, 0, 20)


def iso(seconds):
    return (START + timedelta(seconds=seconds)).isoformat()


def journey(device, make, model, year, modern, speed, weather, incident, status, limit):
    modern = str(modern).lower()
    place = '{"latitude": 51.5, "longitude": -0.13}'
    head = f'"id": "{device}", "deviceId": "{device}"'
    log = [
        (s.VEHICLE_TOPIC, f'{{{head}, "timestamp": "{iso(0)}", "location": {place}, "make": "{make}", "model": "{model}", "year": {year}, '
                          f'"auto_braking_supported": {modern}, "abs_supported": {modern}, "traction_control_supported": {modern}}}'),
        (s.WEATHER_TOPIC, f'{{{head}, "timestamp": "{iso(0)}", "location": {place}, "weatherCondition": "{weather}"}}'),
        (s.EMERGENCY_TOPIC, f'{{{head}, "timestamp": "{iso(0)}", "location": {place}, "type": "{incident}", "status": "{status}"}}'),
        (s.ROUTES_TOPIC, f'{{"deviceID": "{device}", "timestamp": "{iso(0)}", "placeId": "1", "SpeedLimit": {limit}}}'),
    ]
    for i in range(6):
        log.append((s.GPS_TOPIC, f'{{"id": "{device}{i}", "deviceId": "{device}", "timestamp": "{iso(i + 1)}", "speed": {speed}, '
                                 f'"direction": "North-East", "location": [51.5, -0.13]}}'))
    return log


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    at = jobs.Topics(spark, f"{root}/checkpoints", folder=f"{root}/topics")

    def publish(log):
        rows = [(bytearray(b"k"), bytearray(v, "utf-8"), t, 0, i, START) for i, (t, v) in enumerate(log)]
        frame = spark.createDataFrame(rows, topics.ENVELOPE)
        for t in {t for t, _ in log}:
            frame.where(F.col("topic") == t).write.mode("append").parquet(f"{root}/topics/{t}")

    def go(writers):
        for writer in writers:
            run_available(spark, writer, 1)

    publish(journey("lada", "Lada", "2107", 1987, False, 85, "Fog", "None", "Resolved", 60)
            + journey("bmw", "BMW", "X5", 2022, True, 100, "Rain", "Accident", "Active", 70)
            + [(s.TRAFFIC_TOPIC, '{"id": "t", "deviceId": "lada", "cameraId": "Camera123", "timestamp": "2024-01-01T12:00:00"}'),
               (s.GPS_TOPIC, "{bad")])
    go(jobs.metrics_job(at))
    go(jobs.assistant_job(at))
    go(jobs.alerts_job(at))
    go(jobs.archive_job(at, f"{root}/archive"))
    roads = spark.createDataFrame([(1, 51.5001, -0.1301), (2, 51.6, -0.2)], "placeId long, latitude double, longitude double")
    publish([(s.GPS_TOPIC, f'{{"id": "c", "deviceId": "c", "timestamp": "{iso(2000)}", "speed": 50}}'),
             (s.ROUTES_TOPIC, f'{{"deviceId": "c", "timestamp": "{iso(2000)}", "SpeedLimit": 60}}')])
    go(jobs.metrics_job(at))
    go(jobs.evaluator_job(at))
    go(jobs.routes_job(at, roads, f"{root}/routes"))  # last, as its limits would reach the metrics
    return root


def test_evaluations(spark, done):
    rows = spark.read.parquet(f"{done}/topics/{s.EVALUATIONS_TOPIC}").select("key", F.from_json("value", s.MESSAGES[s.EVALUATIONS_TOPIC]).alias("e"))
    got = {r["key"]: (r["e"]["rating"], r["e"]["class"], r["e"]["period"]) for r in rows.collect()}
    period = "2024-01-01T12:00:00/2024-01-01T12:01:00"
    # six events each: 100 - 12 - 0.4 * 25, and 100 - 12 - 0.4 * 30
    assert got == {"lada": (78, "Good", period), "bmw": (76, "Good", period)}


def test_alerts(spark, done):
    advice = spark.read.parquet(f"{done}/topics/{jobs.ADVICE_TOPIC}").count()
    rows = spark.read.parquet(f"{done}/topics/{s.ALERTS_TOPIC}").select(F.from_json("value", s.MESSAGES[s.ALERTS_TOPIC]).alias("a")).select("a.*")
    got = sorted((r["deviceId"], r["action"], r["target_speed"]) for r in rows.collect())
    assert ("lada", "slow_down", 50.0) in got and ("bmw", "slow_down", 60.0) in got
    # at 20, 22, 24, 26 s each, and the first camera message of one device; repeats are dropped
    assert len(got) < advice == 9


def test_routes_and_cache(spark, done):
    sent = spark.read.schema("key string, value string").parquet(f"{done}/topics/{s.ROUTES_TOPIC}").where("key <> 'k'")
    rows = sent.select(F.get_json_object("value", "$.placeId").alias("p"), "key")
    assert sorted((r["key"], r["p"]) for r in rows.collect()) == [("bmw", "1")] * 2 + [("lada", "1")] * 2
    [entry] = CacheTable(spark, f"{done}/routes/cache").writes_before(1_000).select("key").distinct().collect()
    assert entry["key"] == "route:51.5:-0.13"
    assert sorted(r["reject_reason"] for r in spark.read.parquet(f"{done}/routes/rejected").collect()) == ["direction", "malformed"]


def test_cached_routes_are_not_snapped_again(spark):
    at = lambda m: START + timedelta(minutes=m)
    kinds = "id long, deviceId string, event_time timestamp, location array<double>, path array<array<double>>"
    here, there = [51.5, -0.13], [51.7, -0.3]
    windows = spark.createDataFrame([(1, "a", at(10), here, [there] * 3), (2, "b", at(90), here, [there] * 3), (3, "c", at(10), there, [here] * 3)], kinds)
    roads = spark.createDataFrame([(1, 51.5001, -0.1301), (2, 51.7001, -0.3)], "placeId long, latitude double, longitude double")
    first = spark.createDataFrame([(9, "z", at(0), here, [here] * 3)], kinds)
    writes = routes.cache_writes(routes.snap_windows(first, roads))
    got = {r["id"]: (r["placeId"], r["cached"]) for r in routes.cached_or_snapped(windows, roads, writes).collect()}
    assert got == {1: (1, True), 2: (2, False), 3: (1, False)}  # the entry lives an hour
    posted = spark.createDataFrame([(1, 33.0)], "placeId long, speedLimit double")
    limits = {r["id"]: r["SpeedLimit"] for r in routes.with_limit(routes.snap_windows(windows, roads), posted).collect()}
    assert limits[3] == 33.0 and limits[1] != 33.0


def test_queries_run_together_until_one_fails(spark, done, tmp_path):
    at = jobs.Topics(spark, str(tmp_path / "c"), folder=f"{done}/topics", per_trigger=1)
    run_all(spark, jobs.archive_job(at, str(tmp_path / "a")), 1, availableNow=True)
    assert spark.read.parquet(str(tmp_path / "a" / s.GPS_TOPIC)).count() == 13

    def fail(batch, batch_id):
        raise ValueError("no")

    broken = at.read(s.GPS_TOPIC).writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "f"))
    with pytest.raises(Exception, match="no"):
        run_all(spark, [broken, *jobs.metrics_job(jobs.Topics(spark, str(tmp_path / "d"), folder=f"{done}/topics"))], 1)
    assert not spark.streams.active
    # an earlier failure in the session is not raised again
    run_all(spark, jobs.archive_job(jobs.Topics(spark, str(tmp_path / "e"), folder=f"{done}/topics"), str(tmp_path / "b")), 1, availableNow=True)
    assert spark.read.parquet(str(tmp_path / "b" / s.GPS_TOPIC)).count() == 13


def test_archive(spark, done):
    counts = {t: spark.read.parquet(f"{done}/archive/{t}").count() for t in (s.VEHICLE_TOPIC, s.GPS_TOPIC, s.TRAFFIC_TOPIC, s.WEATHER_TOPIC, s.EMERGENCY_TOPIC)}
    assert list(counts.values()) == [2, 12, 1, 2, 2]
    assert spark.read.parquet(f"{done}/archive/{s.TRAFFIC_TOPIC}").first()["cameraID"] == "Camera123"


def test_all_taps_of_the_metrics_job_can_start(spark, done):
    at = jobs.Topics(spark, f"{done}/other", folder=f"{done}/topics")
    assert len(jobs.metrics_job(at, taps=True)) == 6


def test_requests_carry_the_nearest_chunks(spark, done, tmp_path):
    texts = [(1, 0, "fog and rain make the road wet, slow down"), (2, 0, "vehicle car speed limit weather road abs braking system"), (3, 0, "zebra")]
    chunks = build_chunk_vectors(spark.createDataFrame(texts, "doc_id long, chunk_no int, chunk string"))
    index = build_index(chunks, cells=2)
    at = jobs.Topics(spark, str(tmp_path / "c"), folder=f"{done}/topics")
    for writer in jobs.context_job(at, index, chunks, str(tmp_path / "r"), k=2):
        run_available(spark, writer, 1)
    requests = spark.read.parquet(str(tmp_path / "r")).collect()
    assert requests and all(r["request"].count("\n\n") >= 1 and "The vehicle is a" in r["request"] for r in requests)
    assert any("zebra" not in r["request"] and "abs braking" in r["request"] for r in requests)


def test_scorecard_job_runs_next_to_the_others(spark, done, tmp_path):
    at = jobs.Topics(spark, str(tmp_path / "c"), folder=f"{done}/topics")
    names = [w._jwrite is not None for w in jobs.scorecard_job(at, str(tmp_path / "s"))]
    assert names == [True] * 3
