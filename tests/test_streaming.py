"""Streams: closing of windows, late rows, restarts, state, expiry."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Observation, functions as F

from kerbside import schemas as s
from kerbside.operators import metrics as m
from kerbside.operators.joins import interval_join
from kerbside.sinks import writers
from kerbside.sources import topics
from kerbside.sources.envelope import to_envelope
from kerbside.streaming import run, stateful

BASE = datetime(2024, 1, 1, 12, 0, 20)


def at(offset):
    return (BASE + timedelta(seconds=offset)).isoformat(timespec="microseconds")


def messages(spark, topic, bodies):
    rows = [(bytearray(b"k"), bytearray(body, "utf-8"), topic, 0, i, BASE) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, topics.ENVELOPE)


def gps(spark, *fixes, device="v"):
    return messages(spark, s.GPS_TOPIC, [f'{{"deviceId":"{device}","speed":{v},"timestamp":"{at(o)}"}}' for o, v in fixes])


def limits(spark, *records, field="deviceID"):
    return messages(spark, s.ROUTES_TOPIC, [f'{{"{field}":"v","SpeedLimit":{v},"timestamp":"{at(o)}"}}' for o, v in records])


def stage(spark, fixes, records):
    return gps(spark, *fixes).unionByName(limits(spark, *records))


def metrics_stream(log):
    return m.overspeed_metrics_stream(topics.topic_stream(log, s.GPS_TOPIC), topics.speed_limit_stream(log, s.ROUTES_TOPIC))


FIRST = ([(i, 85) for i in range(6)], [(2, 60), (5, 90), (3, 50)])


def test_pairs_are_counted_and_the_window_closes_late(spark):
    """Six fixes against four limits in reach are 24 events; the one-minute window waits for its end plus five minutes."""
    early = [(o, 50) for o in (70, 200, 345)], [(o, 60) for o in (70, 200, 345)]
    stages = [stage(spark, *FIRST), stage(spark, *early)]
    assert run.replay(spark, "open", stages, metrics_stream, partitions=1).count() == 0
    stages[1] = stages[1].unionByName(stage(spark, [(380, 50)], [(380, 60)]))  # watermark 12:06:10, past 12:01 plus five minutes
    [row] = run.replay(spark, "closed", stages, metrics_stream, partitions=1).collect()
    assert row["period"] == "2024-01-01T12:00:00/2024-01-01T12:01:00"
    assert (row["avg_speed_over_limit"], row["overspeed_events"], row["max_speed_over_limit"]) == (27.5, 24, 35.0)
    rated = m.rate(spark.createDataFrame([row])).first()
    assert (rated["rating"], rated["class"]) == (38, "Dangerous")


def test_batch_gives_the_same_numbers(spark):
    log = stage(spark, *FIRST)
    for o in (70, 200, 345, 380, 700):
        log = log.unionByName(stage(spark, [(o, 50)], [(o, 60)]))
    fixes = topics.topic_stream(log, s.GPS_TOPIC)
    posted = topics.speed_limit_stream(log, s.ROUTES_TOPIC).withColumnsRenamed({"deviceId_sl": "deviceId", "event_time_speed": "event_time"})
    [row] = m.overspeed_metrics(fixes, posted).collect()
    assert (row["avg_speed_over_limit"], row["overspeed_events"], row["max_speed_over_limit"]) == (27.5, 24, 35.0)


def test_salted_stream_join_gives_the_same(spark):
    def salted(log):
        fixes, posted = topics.topic_stream(log, s.GPS_TOPIC), topics.speed_limit_stream(log, s.ROUTES_TOPIC)
        return interval_join(fixes, posted, salts=3)

    stages = [stage(spark, *FIRST), stage(spark, [(2000, 1)], [(2000, 60)])]
    got = run.replay(spark, "salted", stages, salted, partitions=2).where("speed > 1").collect()
    assert len(got) == 18 and {r["SpeedLimit"] for r in got} == {60.0, 90.0, 50.0}


def test_either_spelling_of_the_device_advances_time(spark):
    stages = [stage(spark, [(i, 85) for i in range(6)], [(2, 60)])]
    stages.append(gps(spark, (2000, 50)).unionByName(limits(spark, (2000, 60), field="deviceId")))
    assert run.replay(spark, "spelling", stages, metrics_stream, partitions=1).count() == 1


def test_a_record_without_device_does_not_advance_time(spark):
    stages = [stage(spark, [(i, 85) for i in range(6)], [(2, 60)])]
    stages.append(gps(spark, (2000, 50)).unionByName(limits(spark, (2000, 60), field="vehicle")))
    assert run.replay(spark, "nameless", stages, metrics_stream, partitions=1).count() == 0


def test_unmatched_fixes_come_out_with_nulls_once_time_has_passed(spark):
    def joined(log):
        return interval_join(topics.topic_stream(log, s.GPS_TOPIC), topics.speed_limit_stream(log, s.ROUTES_TOPIC))

    stages = [stage(spark, [(0, 85), (1, 40)], [(900, 60)]), stage(spark, [(2000, 1)], [(2000, 60)])]
    got = sorted((r["speed"], r["SpeedLimit"]) for r in run.replay(spark, "left", stages, joined, partitions=1).collect() if r["speed"] > 1)
    assert got == [(40.0, None), (85.0, None)]


def test_filter_on_the_limit_makes_the_join_inner(spark):
    log = stage(spark, *FIRST)
    posted = topics.speed_limit_stream(log, s.ROUTES_TOPIC)
    joined = interval_join(topics.topic_stream(log, s.GPS_TOPIC), posted)
    kind = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in kind(joined)
    assert "LeftOuter" not in kind(joined.where(F.col("speed") > F.col("SpeedLimit")))


def test_restart_repeats_nothing(spark):
    """Every stage resumes from the checkpoint of the one before; a last stage without new rows adds none."""
    stages = [stage(spark, *FIRST), stage(spark, [(2000, 50)], [(2000, 60)]), gps(spark).limit(0)]
    assert run.replay(spark, "restart", stages, metrics_stream, partitions=1).count() == 1


def test_archive_keeps_all_topics_and_splits_by_day(spark, tmp_path):
    log = messages(spark, s.WEATHER_TOPIC, [
        '{"id":"1","deviceId":"v","timestamp":"2024-01-01T10:00:00","location":{"latitude":1.5,"longitude":2.5},"temperature":5}',
        '{"id":"2","deviceId":"v","timestamp":"2024-01-02T10:00:00","location":[3.5,4.5],"temperature":5.5}', "{bad",
    ]).unionByName(gps(spark, (0, 85)))
    log.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(topics.ENVELOPE).parquet(str(tmp_path / "in"))
    rows = {t: topics.topic_stream(stream, t) for t in (s.WEATHER_TOPIC, s.GPS_TOPIC)}
    for query in writers.start_archive(rows, str(tmp_path / "out"), availableNow=True):
        query.awaitTermination()
    saved = spark.read.parquet(str(tmp_path / "out" / "data" / s.WEATHER_TOPIC)).orderBy("id").collect()
    assert [(r["id"], r["location"]["latitude"], str(r["event_date"])) for r in saved] == [("1", 1.5, "2024-01-01"), ("2", 3.5, "2024-01-02")]
    assert spark.read.parquet(str(tmp_path / "out" / "data" / s.GPS_TOPIC)).count() == 1


def test_topic_sink_writes_keyed_json(spark, tmp_path):
    stage(spark, *FIRST).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(topics.ENVELOPE).parquet(str(tmp_path / "in"))
    rows = topics.topic_stream(stream, s.GPS_TOPIC)
    writer = writers.topic_writer(rows, "copy", key="deviceId", fields=["deviceId", "speed"], path=str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"))
    run.run_available(spark, writer)
    got = {(r["key"], r["value"], r["topic"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("v", '{"deviceId":"v","speed":85.0}', "copy")}
    with pytest.raises(ValueError):
        writers.topic_writer(rows, "copy", checkpoint="x")


def test_cache_entries_expire_in_event_time(spark):
    def writes(log):
        rows = topics.parse_messages(log, s.MESSAGES[s.ROUTES_TOPIC], keep=["offset"]).withWatermark("event_time", "10 seconds")
        return stateful.cache_write_stream(rows.select(
            F.lit("k").alias("key"), F.col("SpeedLimit").cast("string").alias("value"), "event_time", F.col("offset").alias("id")), "60 seconds")

    # 50 s is older than the 100 s held and changes nothing; by 400 s the entry of 100 s is gone
    stages = [limits(spark, (0, 1), (100, 2)), limits(spark, (95, 3)), limits(spark, (400, 4))]
    got = run.replay(spark, "expiry", stages, writes, partitions=1).orderBy("event_time").collect()
    assert [r["value"] for r in got] == ["2.0", "4.0"]
    assert [(r["expires_at"] - r["event_time"]).total_seconds() for r in got] == [60.0, 60.0]


def test_bad_state_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with run.state_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_kafka_reader_options(spark):
    """No connector is installed here, so only the refusal can be seen."""
    with pytest.raises(ValueError):
        topics.read_topics(spark, "gps_data")
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topics(spark, ["a", "b"], bootstrap="localhost:1").isStreaming


def test_file_reader_picks_topics(spark, tmp_path):
    stage(spark, *FIRST).write.parquet(str(tmp_path / "log"))
    assert topics.read_topics(spark, s.GPS_TOPIC, path=str(tmp_path / "log"), streaming=False).count() == 6
    assert topics.read_topics(spark, [s.GPS_TOPIC, s.ROUTES_TOPIC], path=str(tmp_path / "log"), streaming=False).count() == 9
    assert topics.read_topics(spark, s.GPS_TOPIC, path=str(tmp_path / "log")).isStreaming


def test_envelope_of_plain_rows(spark):
    rows = spark.createDataFrame([("v", 1.5, BASE)], "deviceId string, speed double, at timestamp")
    row = to_envelope(rows, "t", "deviceId", "at", ["deviceId", "speed"]).first()
    assert (bytes(row["key"]), bytes(row["value"]), row["topic"]) == (b"v", b'{"deviceId":"v","speed":1.5}', "t")


def test_joined_schema(spark):
    log = stage(spark, *FIRST)
    joined = interval_join(topics.topic_stream(log, s.GPS_TOPIC).select("deviceId", "speed", "timestamp", "event_time"),
                           topics.speed_limit_stream(log, s.ROUTES_TOPIC).drop("Timestamp"))
    assert [(f.name, f.dataType.simpleString()) for f in joined.schema] == [
        ("deviceId", "string"), ("speed", "double"), ("timestamp", "string"), ("event_time", "timestamp"),
        ("deviceId_sl", "string"), ("placeId", "string"), ("SpeedLimit", "double"), ("event_time_speed", "timestamp")]


def test_taps_tag_and_count(spark):
    seen = Observation("gps")
    rows = writers.counted(writers.tap(gps(spark, (0, 1), (1, 2)), "GPS RAW"), seen)
    assert {r["DEBUG_TAG"] for r in rows.collect()} == {"GPS RAW"} and seen.get == {"rows": 2}


def test_silent_devices_are_forgotten(spark, tmp_path):
    """Once the watermark is well past a device's last message its state goes, and it starts afresh."""
    kinds = "id long, deviceId string, event_time timestamp"
    start = datetime(2024, 1, 1)

    def send(*rows):
        spark.createDataFrame([(i, d, start + timedelta(seconds=t)) for i, d, t in rows], kinds).write.mode("append").parquet(str(tmp_path / "in"))
        log = spark.readStream.schema(kinds).parquet(str(tmp_path / "in")).withWatermark("event_time", "1 second")
        out = stateful.throttle_stream(log, "2 hours", "1 minute").writeStream.format("parquet").option("path", str(tmp_path / "out"))
        run.run_available(spark, out.option("checkpointLocation", str(tmp_path / "c")), 1)

    send((1, "a", 0), (2, "a", 1), (3, "b", 2))
    send((4, "b", 3600))  # the watermark passes the end of "a"
    send((5, "a", 3601), (6, "b", 3602))
    got = {r["id"]: r["emitted"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: True, 6: False}
