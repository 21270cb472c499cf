"""Column rules: weather labels, road condition, safety rating, feedback and advice."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from kerbside.schemas import (
    FALLBACK_CONDITIONS, POSTED_LIMITS, RISKY_WEATHER, ROAD_CONDITIONS, WEATHER_LABELS,
)


def _literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def weather_label(code: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(WEATHER_LABELS), code.cast("int")), F.lit("Unknown"))


def road_condition(label: Column) -> Column:
    roads = {name: road for name, (_, road) in ROAD_CONDITIONS.items()}
    return F.coalesce(F.try_element_at(_literal_map(roads), label), F.lit("Normal"))


def typical_temperature(label: Column) -> Column:
    return F.try_element_at(_literal_map({name: t for name, (t, _) in ROAD_CONDITIONS.items()}), label)


def is_risky_weather(label: Column) -> Column:
    return F.coalesce(F.lower(label).rlike(RISKY_WEATHER), F.lit(False))


def fallback_condition(key: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in FALLBACK_CONDITIONS]), F.pmod(key, F.lit(4)).cast("int"))


def posted_limit(key: Column) -> Column:
    """One of the posted limits, chosen by an integer key (a fixed choice instead of a random draw)."""
    return F.get(F.array(*[F.lit(float(v)) for v in POSTED_LIMITS]), F.pmod(key, F.lit(len(POSTED_LIMITS))).cast("int"))


def posted_limit_for(place: Column) -> Column:
    """The same for a place id: its number, or its CRC-32 if it is text."""
    text = place.cast("string")
    return posted_limit(F.coalesce(text.try_cast("bigint"), F.crc32(text)))


def has_two_missed_alerts(ignored: Column) -> Column:
    return F.coalesce(ignored, F.lit(0)) >= 2


def safety_score(overspeed_events: Column, max_over: Column, risky: Column, ignored: Column) -> Column:
    """0-100, higher is safer: fixed penalties, unrounded."""
    zero = F.lit(0)
    score = (
        F.lit(100.0)
        - F.coalesce(overspeed_events, zero) * F.lit(2.0)
        - F.coalesce(max_over, F.lit(0.0)) * F.lit(0.4)
        - F.when(F.coalesce(risky, zero) > 0, 10.0).otherwise(0.0)
        - F.when(has_two_missed_alerts(ignored), 10.0).otherwise(0.0)
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))


def safety_rating(overspeed_events: Column, max_over: Column, risky: Column, ignored: Column) -> Column:
    """The score as a whole number; rounded to 9 places first so that 79.5 is not 79.49999."""
    return F.round(F.round(safety_score(overspeed_events, max_over, risky, ignored), 9), 0).cast("int")


#: Lower bounds of the classes; the rubric names the classes but gives no cut-offs, these are ours.
RATING_CLASSES = [(90, "Excellent"), (75, "Good"), (60, "Fair"), (40, "Poor")]


def rating_class(rating: Column) -> Column:
    column = F.when(rating.isNull(), None)
    for bound, name in RATING_CLASSES:
        column = column.when(rating >= bound, name)
    return column.otherwise("Dangerous")


def strengths(overspeed_events: Column, risky: Column, ignored: Column) -> Column:
    return F.concat_ws(
        "; ",
        F.when(F.coalesce(overspeed_events, F.lit(0)) == 0, "Keeps to the speed limit"),
        F.when(F.coalesce(risky, F.lit(0)) == 0, "Careful in bad weather"),
        F.when(F.coalesce(ignored, F.lit(0)) == 0, "Follows advice"),
    )


def weaknesses(overspeed_events: Column, max_over: Column, risky: Column, ignored: Column) -> Column:
    return F.concat_ws(
        "; ",
        F.when(F.coalesce(overspeed_events, F.lit(0)) > 0, "Exceeds the speed limit"),
        F.when(F.coalesce(max_over, F.lit(0.0)) >= 30, "Extreme speeding"),
        F.when(F.coalesce(risky, F.lit(0)) > 0, "Speeds in bad weather"),
        F.when(has_two_missed_alerts(ignored), "Ignores alerts"),
    )


def improvement_tips(overspeed_events: Column, max_over: Column, risky: Column, ignored: Column) -> Column:
    return F.array_compact(F.array(
        F.when(F.coalesce(overspeed_events, F.lit(0)) > 0, "Watch the posted limit"),
        F.when(F.coalesce(max_over, F.lit(0.0)) >= 30, "Brake early before slower zones"),
        F.when(F.coalesce(risky, F.lit(0)) > 0, "Drive slower in rain, fog and snow"),
        F.when(has_two_missed_alerts(ignored), "React to the first alert"),
    ))


def rule_advice(speed: Column, limit: Column, weather: Column, road: Column, active_incident: Column,
                auto_braking: Column, abs_system: Column, traction: Column) -> Column:
    """``action``, ``target_speed`` and ``reason`` by fixed thresholds.

    Risky conditions, or less than 5 below the limit: slow down to 10 below the limit at most. At least 20 below it with
    a clear sky, normal road and every safety feature: 10 faster, but 5 below the limit. Otherwise maintain.
    """
    speed = F.coalesce(speed, F.lit(0.0))
    limit = F.coalesce(limit, F.lit(90.0))
    weather = F.coalesce(weather, F.lit("Clear sky"))
    road = F.coalesce(road, F.lit("Normal"))
    risky = is_risky_weather(weather) | (road != "Normal") | F.coalesce(active_incident, F.lit(False))
    equipped = F.coalesce(auto_braking, F.lit(False)) & F.coalesce(abs_system, F.lit(False)) \
        & F.coalesce(traction, F.lit(False))
    close = speed >= limit - 5
    faster = (speed <= limit - 20) & weather.isin("Clear sky", "Mainly clear") & (road == "Normal") & equipped
    action = F.when(risky | close, "slow_down").when(faster, "speed_up").otherwise("maintain_speed")
    target = (
        F.when(risky | close, F.least(limit - 10, speed))
        .when(faster, F.least(speed + 10, limit - 5))
        .otherwise(speed)
    )
    reason = (
        F.when(risky, "risky conditions").when(close, "close to the limit")
        .when(faster, "excellent conditions").otherwise("steady conditions")
    )
    return F.struct(action.alias("action"), target.alias("target_speed"), reason.alias("reason"))
