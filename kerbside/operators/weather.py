"""Weather at a place and time from observations, instead of a weather service."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.functions.rules import fallback_condition
from kerbside.operators.joins import as_of


def on_grid(rows: DataFrame, cell: float) -> DataFrame:
    return rows.withColumns({"_x": F.floor(F.col("latitude") / cell), "_y": F.floor(F.col("longitude") / cell)})


def weather_enrich(places: DataFrame, observations: DataFrame, cell: float = 0.1, max_age: str = "1 hour",
                   rows_per_slice: int | None = None) -> DataFrame:
    """Each place (``id``, ``latitude``, ``longitude``, ``event_time``) with the latest observation of its grid cell.

    Without one that is recent enough the fallback fills in: values inside the usual ranges, chosen by the row's id so
    that a task that runs again gives the same ones, plus precipitation, humidity and air quality.
    """
    known = as_of(
        on_grid(places, cell), on_grid(observations, cell), ["_x", "_y"], F.col("event_time"),
        ["temperature", "weatherCondition", "windSpeed"], ["id"], max_age, rows_per_slice=rows_per_slice,
    )
    missing = F.col("right_at").isNull()
    # numbers as they are, any other id by its hash
    key = F.coalesce(F.col("id").cast("string").try_cast("bigint"), F.xxhash64("id"))

    def drawn(span: int, shift: int = 0):
        return (F.pmod(key, F.lit(span)) + shift).cast("double")

    return known.withColumns({
        "temperature": F.when(missing, drawn(32, -5)).otherwise(F.col("temperature")),
        "weatherCondition": F.when(missing, fallback_condition(key)).otherwise(F.col("weatherCondition")),
        "windSpeed": F.when(missing, drawn(101)).otherwise(F.col("windSpeed")),
        "precipitation": F.when(missing, drawn(26)),
        "humidity": F.when(missing, F.pmod(key, F.lit(101)).cast("int")),
        "airQualityIndex": F.when(missing, drawn(501)),
        "observed": ~missing,
    }).drop("_x", "_y", "right_at")
