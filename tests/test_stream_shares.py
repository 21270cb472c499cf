"""Streams keyed by shares of devices and by stretches of time: as many calls and comparisons as the rows need, and the same rows."""

import random
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from kerbside.operators import joins
from kerbside.streaming import asof, run, stateful

BASE = datetime(2024, 1, 1)
MESSAGES = "id string, topic string, deviceId string, event_time timestamp, speed double, label string"


def sent(spark, folder, rows, kinds):
    spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(kinds).parquet(f"{folder}/in")


def stated(spark, folder, stages, shares, **how):
    for stage in stages:
        log = sent(spark, folder, stage, MESSAGES).withWatermark("event_time", "1 second")
        out = stateful.state_stream(log, {"speed": "double", "label": "string"}, "7 seconds", shares=shares, **how)
        run.run_available(spark, out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c"), 2)
    return sorted(map(tuple, spark.read.parquet(f"{folder}/out").collect()))


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def expected(rows):
    """One message after the other, a device's newest values by hand."""
    known, last, out = {}, {}, []
    for i, topic, device, when, speed, label in sorted(rows, key=lambda r: (r[3], r[0], r[1])):
        old = known.get(device, (None, None))
        known[device] = (old[0] if speed is None else speed, old[1] if label is None else label)
        if device not in last or when - last[device] >= timedelta(seconds=7):
            last[device] = when
            out.append((i, topic, device, when, *known[device]))
    return sorted(out)


def test_devices_of_one_share_keep_apart(spark, tmp_path):
    rng = random.Random(4)
    rows = [(str(i), "t", f"d{rng.randrange(9)}", at(i // 3), rng.choice([None, 1.5, 2.5]), rng.choice([None, "Fog", "Rain"])) for i in range(300)]
    want = expected(rows)
    assert stated(spark, str(tmp_path / "one"), [rows[:150], rows[150:]], 1) == want
    assert stated(spark, str(tmp_path / "many"), [rows[:150], rows[150:]], 64, forget="1 day") == want


def test_a_silent_device_is_forgotten_beside_a_busy_one(spark, tmp_path):
    stages = [[("1", "t", "a", at(0), 1.5, "Fog"), ("2", "t", "b", at(1), 2.5, None)], [("3", "t", "b", at(3600), None, None)],
              [("4", "t", "a", at(3601), None, "Rain"), ("5", "t", "b", at(3610), None, None)]]
    got = {r[0]: r[4:] for r in stated(spark, str(tmp_path), stages, 1, forget="1 minute")}
    assert got == {"1": (1.5, "Fog"), "2": (2.5, None), "3": (2.5, None), "4": (None, "Rain"), "5": (2.5, None)}


def test_many_devices_are_one_call_of_the_as_of_join(spark, tmp_path):
    """Before, each device was a call, and a dozen round trips to the state store."""
    kinds = "id long, deviceId string, event_time timestamp, side string, v double"
    rows = [(i, f"d{i % 50}", at(i), "lr"[i % 50 % 3 == i // 50 % 3], float(i)) for i in range(400)]
    for stage in (rows, [(-1, "closer", at(90_000), "l", 0.0)]):
        log = sent(spark, str(tmp_path), stage, kinds)
        left, right = log.where("side = 'l'").drop("side"), log.where("side = 'r'").select("id", "deviceId", "event_time", F.col("v").alias("w"))
        joined = asof.as_of_stream(left, right, ["w"], late="5 seconds", shares=1)
        run.run_available(spark, joined.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c"), 2)
    got = {r["id"]: r["w"] for r in spark.read.parquet(f"{tmp_path}/out").where("id >= 0").collect()}
    frame = pd.DataFrame(rows, columns=["id", "d", "t", "side", "v"])
    frame["w"] = frame["v"].where(frame["side"] == "r").groupby(frame["d"]).ffill()
    lefts = frame[frame["side"] == "l"]
    assert got == {i: None if pd.isna(w) else w for i, w in zip(lefts["id"], lefts["w"])} and len(set(got.values())) > 50
    held = spark.read.format("statestore").load(f"{tmp_path}/c")
    assert held.count() == 1  # all devices in one row


def test_interval_join_meets_only_its_stretch_of_time(spark, tmp_path):
    """Under one key of the state stand the rows of one device and a few tolerances, not all that the device ever sent."""
    kinds = "deviceId string, event_time timestamp, side string, v double"
    rows = [("a", BASE + timedelta(minutes=i), "lr"[i % 2], float(i)) for i in range(200)]
    log = sent(spark, str(tmp_path), rows, kinds)
    gps = log.where("side = 'l'").select("deviceId", "event_time", F.col("v").alias("speed")).withWatermark("event_time", "1 day")
    limits = log.where("side = 'r'").select(F.col("deviceId").alias("deviceId_sl"), F.col("event_time").alias("event_time_speed"),
                                            F.col("v").alias("SpeedLimit")).withWatermark("event_time_speed", "1 day")
    joined = joins.interval_join(gps, limits, "5 minutes", "inner")
    run.run_available(spark, joined.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c"), 2)
    got = {(r["speed"], r["SpeedLimit"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(float(i), float(j)) for i in range(0, 200, 2) for j in range(1, 200, 2) if abs(i - j) <= 5}
    held = run.join_state(spark, f"{tmp_path}/c", right_where=joins.held_once("5 minutes"))
    assert {r["side"]: r["count"] for r in held.groupBy("side").count().collect()} == {"left": 100, "right": 100}
    per_key = run.join_state(spark, f"{tmp_path}/c").groupBy("side", F.regexp_replace("key", '"index":[^,}]*', "")).count()
    assert per_key.agg(F.max("count")).first()[0] <= 16  # of 100
