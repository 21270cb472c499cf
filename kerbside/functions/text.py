"""Text columns: labels, answer cleaning, prompts, answer parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kerbside.schemas import ADVICE, EVALUATION_LIST, SNAPPED_ANSWER, SNAPPED_POINTS, SPEED_LIMIT_RESPONSE

SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

#: Whitespace at either end, Unicode spaces and separators included.
_EDGES = r"^[\s\x0B\x1c-\x1f\x85\p{Z}]+|[\s\x0B\x1c-\x1f\x85\p{Z}]+$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGES, "")


def period_label(start: Column, end: Column) -> Column:
    return F.concat_ws("/", F.date_format(start, SECONDS), F.date_format(end, SECONDS))


def strip_code_fence(text: Column) -> Column:
    """Drop code fences (with or without a ``json`` tag in any case), then trim."""
    return strip(F.regexp_replace(text, "(?i)```(json)?", ""))


def clean_advice_text(text: Column) -> Column:
    """Trim, drop fences and every literal ``json``, wherever it stands, then trim again."""
    cleaned = strip(text)
    for gone in ("```json", "```", "json\n", "json"):
        cleaned = F.replace(cleaned, F.lit(gone), F.lit(""))
    return strip(cleaned)


def route_path(points: Column) -> Column:
    """``lat,lng%7Clat,lng`` of an array of ``[lat, lng]``."""
    return F.array_join(
        F.transform(points, lambda p: F.concat_ws(",", F.get(p, F.lit(0)).cast("string"), F.get(p, F.lit(1)).cast("string"))),
        "%7C",
    )


def first_snapped_point(answer: Column) -> Column:
    """First point of a snapping answer, ``{"snappedPoints": [...]}`` or the bare list; no points give null."""
    whole = F.from_json(answer, SNAPPED_ANSWER)["snappedPoints"]
    points = F.when(F.ltrim(answer).startswith("["), F.from_json(answer, SNAPPED_POINTS)).otherwise(whole)
    return F.get(points, F.lit(0))


def first_speed_limit(answer: Column) -> Column:
    """First limit of a speed-limit answer, null when there is none."""
    return F.get(F.from_json(answer, SPEED_LIMIT_RESPONSE)["speedLimits"], F.lit(0))["speedLimit"]


def _or(column: Column, default: str) -> Column:
    return F.coalesce(column.cast("string"), F.lit(default))


def _ability(has: Column, yes: str, no: str) -> Column:
    return F.when(has, yes).otherwise(no)


# Sentences of the advice request; the answer format depends on them.
VEHICLE_SENTENCE = ("The vehicle is a ", ".")
ABILITY_SENTENCES = [
    ("auto_braking_supported", "It supports auto-braking.", "It does not support auto-braking."),
    ("abs_supported", "It has ABS braking system.", "It does not have ABS braking system."),
    ("traction_control_supported", "It has traction control system.", "It does not have traction control system."),
]
SPEED_SENTENCE = ("The car is moving at ", " km/h where the speed limit is ", " km/h.")
WEATHER_SENTENCE = ("Weather is ", ", and road condition is ", ".")
GUIDANCE = [
    "Evaluate whether the vehicle should slow down, maintain speed, or speed up.",
    "Only suggest to speed up if all conditions are excellent: clear weather, dry road, and vehicle has all modern "
    "safety features.",
    "If current speed is significantly below the limit and conditions are good, modestly increasing speed may be safe.",
    "If speed is too close to the limit or the conditions are risky (e.g., fog, snow, wet roads), suggest slowing down.",
    "Return ONLY a JSON object with keys: action (slow_down / maintain_speed / speed_up), target_speed (int), and "
    "reason (string).",
]
DEFAULT_LIMIT = 90


def advice_prompt(speed: Column, limit: Column, make: Column, model: Column, year: Column, auto_braking: Column,
                  abs_system: Column, traction: Column, weather: Column, road: Column) -> Column:
    """The advice request for a device's last known state."""
    abilities = zip((auto_braking, abs_system, traction), ABILITY_SENTENCES)
    a, b, c = SPEED_SENTENCE
    d, e, f = WEATHER_SENTENCE
    parts = [
        F.concat(F.lit(VEHICLE_SENTENCE[0]), _or(year, "unknown"), F.lit(" "), _or(make, "unknown"), F.lit(" "),
                 _or(model, "unknown"), F.lit(VEHICLE_SENTENCE[1])),
        *[_ability(has, yes, no) for has, (_, yes, no) in abilities],
        F.concat(F.lit(a), _or(F.round(speed, 2), "0"), F.lit(b), _or(F.round(limit, 2), str(DEFAULT_LIMIT)), F.lit(c)),
        F.concat(F.lit(d), _or(weather, "Clear sky"), F.lit(e), _or(road, "Normal"), F.lit(f)),
        *[F.lit(sentence) for sentence in GUIDANCE],
    ]
    return F.concat_ws(" ", *parts)


# Text of the scoring request up to the entries.
SCORING_RULES = """You are a strict driving-style assessor. Each entry below contains JSON driving metrics. 

Rules for evaluating safety score (0–100, higher = safer):
- Penalty: 2 points × overspeed_events
- Penalty: 0.4 points × max_speed_over_limit
- If risky_weather_overspeed > 0 add 10-point penalty
- If ignored_alerts ≥ 2 add 10-point penalty
- Clamp rating to 0–100

Return ONLY valid JSON list like:
[
  {
    "index": <int>,
    "rating": <int>,
    "class": "Excellent|Good|Fair|Poor|Dangerous",
    "strengths": "<string>",
    "weaknesses": "<string>",
    "improvement_tips": ["<tip1>", "<tip2>"]
  },
  
]

Input metrics:

"""


def _json_text(value: Column) -> Column:
    """A value as JSON text."""
    return F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def pretty_json(fields: dict[str, Column]) -> Column:
    """A JSON object with an indent of two spaces; null fields are written as ``null``."""
    lines = [
        F.concat(F.lit(f'  "{name}": '), F.when(value.isNull(), "null").otherwise(_json_text(value)))
        for name, value in fields.items()
    ]
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *lines), F.lit("\n}"))


def scoring_prompt(entries: Column) -> Column:
    """The scoring request for an array of metric texts."""
    numbered = F.transform(entries, lambda e, i: F.concat(F.lit("["), i.cast("string"), F.lit("]:\n"), e, F.lit("\n\n")))
    return F.concat(F.lit(SCORING_RULES), F.array_join(numbered, ""))


def parse_advice(rows: DataFrame, text: str, device: str, at: Column) -> DataFrame:
    """Advice text -> ``action``, ``target_speed``, ``reason``, ``deviceId``, ``ts``; ``reject_reason`` if unusable.

    The advice may name another device, never another time.
    """
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    schema = StructType([*ADVICE.fields, StructField("_corrupt", StringType(), True)])
    parsed = rows.withColumn("_a", F.from_json(clean_advice_text(F.col(text)), schema, options))
    bad = (
        F.when(F.col("_a").isNull() | F.col("_a._corrupt").isNotNull(), "malformed")
        .when(F.col("_a.action").isNull(), "action")
        .when(F.col("_a.target_speed").isNull(), "target_speed")
    )
    return parsed.withColumns({
        "deviceId": F.coalesce("_a.deviceId", F.col(device)),
        "action": F.col("_a.action"), "target_speed": F.col("_a.target_speed"), "reason": F.col("_a.reason"),
        "ts": F.unix_millis(at), "reject_reason": bad,
    }).drop("_a")


def parse_evaluations(rows: DataFrame, text: str, batch: str) -> DataFrame:
    """Scoring text -> one row per evaluation with the ``deviceId`` and ``period`` of the metric its index names.

    ``batch`` is the array of scored metrics. A negative index counts from the end; the first index outside the batch
    ends the list. Text that is no list of objects gives no rows.
    """
    size = F.size(batch)
    inside = lambda e: F.coalesce((e["index"] >= -size) & (e["index"] < size), F.lit(False))
    answer = strip_code_fence(F.col(text))  # a single object would parse as a list of one
    parsed = rows.withColumn("_all", F.when(answer.startswith("["), F.from_json(answer, EVALUATION_LIST)))
    first_bad = F.array_position(F.transform("_all", inside), F.lit(False))
    usable = F.when(first_bad > 0, F.slice("_all", 1, (first_bad - 1).cast("int"))).otherwise(F.col("_all"))
    keep = [c for c in rows.columns if c not in (text, batch)]
    item = parsed.select(*keep, batch, F.explode(usable).alias("e"))
    at = F.when(F.col("e.index") < 0, F.col("e.index") + size).otherwise(F.col("e.index"))
    metric = F.get(F.col(batch), at)
    return item.select(*keep, "e.*", metric["deviceId"].alias("deviceId"), metric["period"].alias("period"))
