"""The streaming as-of join and the scorecard on the stream: against the batch twins, late rows, restarts, state."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside import schemas as s
from kerbside.operators import metrics as m
from kerbside.operators.joins import as_of
from kerbside.plans import streams
from kerbside.sources import topics
from kerbside.streaming import asof, run
from tests.test_streaming import messages

BASE = datetime(2024, 1, 1)
SCHEMA = "id long, deviceId string, event_time timestamp, side string, v double"


def rows(n=400, devices=4, seconds=500):
    rng = random.Random(n)
    out = [(i, f"d{rng.randrange(devices)}", BASE + timedelta(seconds=rng.randrange(seconds)), rng.choice("lr"), rng.choice([1.5, 2.5, None])) for i in range(n)]
    return sorted(out, key=lambda r: r[2])


def two_sides(frame):
    return frame.where("side = 'l'").drop("side"), frame.where("side = 'r'").select("id", "deviceId", "event_time", F.col("v").alias("w"))


def streamed(spark, folder, stages, **how):
    for stage in stages:
        spark.createDataFrame(stage, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        left, right = two_sides(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"))
        joined = asof.as_of_stream(left, right, ["w"], late="5 seconds", **how)
        writer = joined.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
        run.run_available(spark, writer, 2)
    return spark.read.parquet(f"{folder}/out")


def closer(days=1):
    return [(-1, "closer", BASE + timedelta(days=days), "l", 0.0)]


@pytest.mark.parametrize("how", [{}, {"max_age": "7 seconds"}, {"max_age": "4 seconds", "forward": True}])
def test_same_as_the_batch_join_over_restarts(spark, tmp_path, how):
    data = rows()
    # messages of one stage come in any order, a stage begins where the one before ended
    stages = [random.Random(i).sample(data[i:i + 150], len(data[i:i + 150])) for i in range(0, 400, 150)]
    got = streamed(spark, str(tmp_path), [*stages, closer()], **how)
    left, right = two_sides(spark.createDataFrame(data, SCHEMA))
    want = as_of(left, right, ["deviceId"], F.col("event_time"), ["w"], ["id"], **how)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_late_rows_are_dropped_and_silent_keys_forgotten(spark, tmp_path):
    at = lambda x: BASE + timedelta(seconds=x)
    stages = [[(1, "a", at(0), "r", 1.5), (2, "a", at(100), "l", 0.0)], [(3, "a", at(50), "r", 2.5), (4, "a", at(101), "l", 0.0)],
              closer(), [(5, "a", at(90_000), "l", 0.0)], closer(2)]
    got = {r["id"]: r["w"] for r in streamed(spark, str(tmp_path / "x"), stages).collect()}
    assert got == {2: 1.5, 4: 1.5, 5: 1.5, -1: None}  # id 3 is behind the watermark, which stood at 95
    got = {r["id"]: r["w"] for r in streamed(spark, str(tmp_path / "y"), stages, forget="1 hour").collect()}
    assert got == {2: 1.5, 4: 1.5, 5: None, -1: None}


def test_looking_forward_needs_a_limit(spark):
    left, right = two_sides(spark.createDataFrame([], SCHEMA))
    with pytest.raises(ValueError):
        asof.as_of_stream(left, right, ["w"], forward=True)


def iso(offset):
    return (BASE + timedelta(seconds=offset)).isoformat(timespec="microseconds")


def test_scorecard_on_the_stream_equals_the_batch(spark):
    rng = random.Random(8)
    bodies = {s.GPS_TOPIC: [], s.ROUTES_TOPIC: [], s.WEATHER_TOPIC: [], s.ALERTS_TOPIC: []}
    for i in range(120):
        device, at = f"d{rng.randrange(3)}", rng.randrange(1_200)
        bodies[s.GPS_TOPIC].append((at, f'{{"id":"{i}","deviceId":"{device}","speed":{rng.randrange(40, 120)},"timestamp":"{iso(at)}"}}'))
        if i % 3 == 0:
            bodies[s.ROUTES_TOPIC].append((at + 1, f'{{"deviceId":"{device}","SpeedLimit":{rng.randrange(50, 90)},"timestamp":"{iso(at + 1)}"}}'))
            label = rng.choice(["Clear sky", "Heavy Rain", "Fog"])
            bodies[s.WEATHER_TOPIC].append((at + 2, f'{{"id":"{i}","deviceId":"{device}","weatherCondition":"{label}","timestamp":"{iso(at + 2)}"}}'))
            ms = int((BASE + timedelta(seconds=at - 3)).timestamp() * 1000)
            bodies[s.ALERTS_TOPIC].append((at - 3, f'{{"deviceId":"{device}","action":"slow_down","target_speed":{rng.randrange(40, 90)},"ts":{ms}}}'))
    stages = []
    for low, high in ((-9, 600), (600, 2_000), (9_000, 0), (18_000, 0)):
        stage = None
        for topic, sent in bodies.items():
            if high:
                text = [body for at, body in sent if low <= at < high]
            else:  # records of a device that closes the windows
                ms = int((BASE + timedelta(seconds=low)).timestamp() * 1000)
                text = [f'{{"id":"x","deviceId":"closer","speed":5,"SpeedLimit":60,"weatherCondition":"Fog","action":"slow_down","target_speed":90,"ts":{ms},"timestamp":"{iso(low)}"}}']
            frame = messages(spark, topic, text)
            stage = frame if stage is None else stage.unionByName(frame)
        stages.append(stage)
    got = streams.published_scorecards(spark, stages, tolerance="1 minute", window="5 minutes", horizon="40 seconds")
    log = stages[0].unionByName(stages[1])
    gps, weather = (topics.topic_stream(log, t) for t in (s.GPS_TOPIC, s.WEATHER_TOPIC))
    want = m.driver_scorecard(gps, topics.topic_stream(log, s.ROUTES_TOPIC), weather, topics.alert_stream(log), "1 minute", "5 minutes", "40 seconds")
    columns = ["deviceId", "period", "overspeed_events", "max_speed_over_limit", "risky_weather_overspeed", "ignored_alerts", "rating", "class"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    assert want.agg(F.sum("ignored_alerts"), F.sum("risky_weather_overspeed")).first()[0] > 0
