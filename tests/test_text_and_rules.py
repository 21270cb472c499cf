"""Scalar semantics: cleaning, parsing, prompts, rating, advice, labels."""

import pytest
from pyspark.sql import functions as F

from kerbside.functions import rules, text
from kerbside.operators import metrics as m
from kerbside.operators.retrieval import CHUNK_OVERLAP, CHUNK_SIZE, recursive_chunks
from kerbside.schemas import POSTED_LIMITS, WEATHER_LABELS


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("raw, want", [
    ("```json\n[1]\n```", "[1]"), ("```JSON\n[1]```  ", "[1]"), (" [1] ", "[1]"), (" x ", "x"), ("a json b", "a json b"),
])
def test_strip_code_fence(spark, raw, want):
    assert value(spark, text.strip_code_fence(F.lit(raw))) == want


@pytest.mark.parametrize("raw, want", [
    ('```json\n{"reason": "see json notes"}\n```', '{"reason": "see  notes"}'), ("json\nx", "x"), ("```x```", "x"), ("JSON", "JSON"),
])
def test_clean_advice_drops_the_word_everywhere(spark, raw, want):
    assert value(spark, text.clean_advice_text(F.lit(raw))) == want


def advice(spark, raw):
    rows = spark.createDataFrame([(raw, "v")], "answer string, device string")
    return text.parse_advice(rows, "answer", "device", F.timestamp_millis(F.lit(1500))).first()


def test_parse_advice(spark):
    good = advice(spark, '```json\n{"action": "slow_down", "target_speed": 50, "reason": "fog", "ts": 3}\n```')
    assert (good["deviceId"], good["action"], good["target_speed"], good["ts"], good["reject_reason"]) == ("v", "slow_down", 50.0, 1500, None)
    assert advice(spark, '{"action": "slow_down", "target_speed": 5, "deviceId": "w"}')["deviceId"] == "w"
    assert advice(spark, '{"target_speed": 50}')["reject_reason"] == "action"
    assert advice(spark, '{"action": "slow_down"}')["reject_reason"] == "target_speed"
    assert advice(spark, "Slow down!")["reject_reason"] == "malformed"


def test_parse_evaluations_stops_at_an_index_outside_the_batch(spark):
    batch = [("a", "p1"), ("b", "p2")]
    schema = "answer string, batch array<struct<deviceId:string,period:string>>"
    items = lambda *idx: "[" + ",".join(f'{{"index": {i}, "rating": 1, "class": "Poor"}}' for i in idx) + "]"
    def devices(raw):
        rows = spark.createDataFrame([(raw, batch)], schema)
        return [r["deviceId"] for r in text.parse_evaluations(rows, "answer", "batch").collect()]

    assert devices(items(0, 1)) == ["a", "b"]
    assert devices(items(1, 2, 0)) == ["b"]
    assert devices(items(-1, 0)) == ["b", "a"]
    assert devices("no list") == []


def test_evaluation_of_a_metric_without_period(spark):
    rows = spark.createDataFrame([('[{"index": 0, "rating": 5}]', [("Vehicle_001", None)])], "answer string, batch array<struct<deviceId:string,period:string>>")
    row = text.parse_evaluations(rows, "answer", "batch").first()
    assert (row["deviceId"], row["period"], row["rating"]) == ("Vehicle_001", None, 5)


def test_advice_prompt_of_an_unknown_device(spark):
    null = F.lit(None)
    prompt = value(spark, text.advice_prompt(*[null.cast("double")] * 2, *[null.cast("string")] * 2, null.cast("int"), *[null.cast("boolean")] * 3, *[null.cast("string")] * 2))
    assert prompt.startswith("The vehicle is a unknown unknown unknown. It does not support auto-braking. It does not have ABS")
    assert "moving at 0 km/h where the speed limit is 90 km/h. Weather is Clear sky, and road condition is Normal." in prompt


def test_scoring_prompt_lists_entries(spark):
    entry = text.pretty_json({"deviceId": F.lit('v"1'), "period": F.lit(None).cast("string"), "n": F.lit(2)})
    assert value(spark, entry) == '{\n  "deviceId": "v\\"1",\n  "period": null,\n  "n": 2\n}'
    assert value(spark, text.scoring_prompt(F.array(F.lit("{}"), F.lit("{}")))).endswith("Input metrics:\n\n[0]:\n{}\n\n[1]:\n{}\n\n")


@pytest.mark.parametrize("events, worst, risky, ignored, rating, name", [
    (0, 0.0, 0, 0, 100, "Excellent"), (24, 35.0, None, None, 38, "Dangerous"), (3, 10.0, 1, 0, 80, "Good"),
    (3, 10.0, 1, 2, 70, "Fair"), (3, 10.0, 1, 1, 80, "Good"), (100, 90.0, 9, 9, 0, "Dangerous"), (20, 50.0, 0, 0, 40, "Poor"),
    (2, None, None, None, 96, "Excellent"),
])
def test_rating(spark, events, worst, risky, ignored, rating, name):
    rows = spark.createDataFrame([(events, worst, risky, ignored)],
        "overspeed_events long, max_speed_over_limit double, risky_weather_overspeed long, ignored_alerts long")
    row = m.rate(rows).first()
    assert (row["rating"], row["class"]) == (rating, name)


def test_metrics_message_without_optional_fields_is_rated(spark):
    row = m.rate(spark.createDataFrame([("Vehicle_001", 2)], "deviceId string, overspeed_events long")).first()
    assert (row["rating"], row["improvement_tips"]) == (96, ["Watch the posted limit"])


@pytest.mark.parametrize("speed, limit, weather, incident, modern, want", [
    (85, 60, "Fog", False, False, ("slow_down", 50)), (100, 70, "Rain", True, True, ("slow_down", 60)),
    (58, 60, "Clear sky", False, True, ("slow_down", 50)), (50, 90, "Clear sky", False, True, ("speed_up", 60)),
    (68, 90, "Clear sky", False, True, ("speed_up", 78)), (50, 90, "Clear sky", False, False, ("maintain_speed", 50)),
    (75, 90, None, False, True, ("maintain_speed", 75)), (None, None, None, False, True, ("speed_up", 10)),
])
def test_rule_advice(spark, speed, limit, weather, incident, modern, want):
    modern = F.lit(modern)
    got = value(spark, rules.rule_advice(F.lit(speed).cast("double"), F.lit(limit).cast("double"), F.lit(weather).cast("string"),
                                         rules.road_condition(F.lit(weather).cast("string")), F.lit(incident), modern, modern, modern))
    assert (got["action"], got["target_speed"]) == want


def test_labels_and_limits(spark):
    for code, label in [*WEATHER_LABELS.items(), (77, "Unknown"), (None, "Unknown")]:
        assert value(spark, rules.weather_label(F.lit(code).cast("int"))) == label
    assert value(spark, rules.road_condition(F.lit("Ice"))) == "Icy" and value(spark, rules.road_condition(F.lit(None).cast("string"))) == "Normal"
    assert {value(spark, rules.posted_limit(F.lit(i))) for i in range(-8, 8)} == set(map(float, POSTED_LIMITS))
    assert value(spark, rules.posted_limit_for(F.lit("ChIJ"))) in POSTED_LIMITS


def test_recursive_chunks_cut_at_the_best_places():
    paragraphs = ["word " * 100 + f"end{i}" for i in range(6)]
    chunks = recursive_chunks("\n\n".join(paragraphs), CHUNK_SIZE, CHUNK_OVERLAP)
    assert chunks == [p.strip() for p in paragraphs]  # two do not fit, and none is short enough to be kept over
    numbers = lambda sep, n: sep.join(f"{i:05d}" for i in range(n))
    body = numbers(" ", 700) + "\n\n" + numbers("", 500) + "\n" + numbers("\nline ", 300)
    for whole in (body, "", "short", "y" * 800, numbers("", 161), numbers("b ", 600), " \n\n "):
        chunks = recursive_chunks(whole, CHUNK_SIZE, CHUNK_OVERLAP)
        assert all(0 < len(c) <= CHUNK_SIZE and c == c.strip() for c in chunks)
        at = 0
        for chunk in chunks:  # in order, with nothing but blanks left out
            start = whole.index(chunk, max(0, at - CHUNK_OVERLAP - 2))
            assert not whole[at:start].strip()
            at = max(at, start + len(chunk))
        assert not whole[at:].strip()
    words = recursive_chunks(numbers(" ", 700), CHUNK_SIZE, CHUNK_OVERLAP)
    assert all(a.endswith(b[:95]) for a, b in zip(words, words[1:]))  # an overlap of whole words


def test_snapping_answers(spark):
    point = '{"location": {"latitude": 1.5, "longitude": 2.5}, "placeId": "p", "originalIndex": 0}'
    for answer in (f'{{"snappedPoints": [{point}, {point}]}}', f'[{point}]'):
        assert value(spark, text.first_snapped_point(F.lit(answer)))["placeId"] == "p"
    for answer in ('{"snappedPoints": []}', "{}", "[]", "no answer"):
        assert value(spark, text.first_snapped_point(F.lit(answer))) is None


def test_a_single_evaluation_object_is_no_list(spark):
    rows = spark.createDataFrame([('{"index": 0, "rating": 5}',), ('[{"index": 0, "rating": 5}]',)], "answer string").withColumn(
        "batch", F.array(F.struct(F.lit("d").alias("deviceId"), F.lit("p").alias("period"))))
    assert [r["rating"] for r in text.parse_evaluations(rows, "answer", "batch").collect()] == [5]
