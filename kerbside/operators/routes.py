"""Fixes -> snapped road points with a speed limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions.rules import posted_limit_for
from kerbside.operators.cache import TIME_TO_LIVE, cache_lookup, route_key
from kerbside.operators.joins import lookup, snap_to_road, speed_limit_lookup
from kerbside.operators.windows import count_windows

CACHED_POINT = "location STRUCT<latitude: DOUBLE, longitude: DOUBLE>, place_id STRING, original_index INT"


def snapped_routes(gps: DataFrame, roads: DataFrame, size: int = 3, per_device: bool = True,
                   rows_per_slice: int | None = None) -> DataFrame:
    """Every ``size`` fixes: the road point nearest to the first, with device, time and place of the last."""
    return snap_windows(count_windows(gps, size, per_device, rows_per_slice), roads, rows_per_slice)


def snap_windows(windows: DataFrame, roads: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """The road point nearest to the first place of each window; a window without one gives no row."""
    first = F.get("path", F.lit(0))
    points = windows.withColumns({"latitude": F.get(first, F.lit(0)), "longitude": F.get(first, F.lit(1))})
    nearest = snap_to_road(points, roads, rows_per_slice=rows_per_slice)
    # distinct places: a hot place is salted
    found = lookup(points, nearest, ["latitude", "longitude"], ["id"], rows_per_slice).where("placeId IS NOT NULL")
    return found.select("id", "deviceId", "event_time", "location", "placeId", "road_latitude", "road_longitude")


def cache_keys(windows: DataFrame) -> DataFrame:
    """Windows with the cache ``key`` of their last place."""
    place = F.col("location")
    return windows.withColumn("key", route_key(F.get(place, F.lit(0)), F.get(place, F.lit(1))))


def cached_or_snapped(windows: DataFrame, roads: DataFrame, writes: DataFrame, ttl: str = TIME_TO_LIVE,
                      rows_per_slice: int | None = None) -> DataFrame:
    """As ``snap_windows``, but a window whose last place has a live cache entry takes the point from there; only the others
    are snapped. Adds ``cached``. ``writes`` are cache writes (``key``, ``value``, ``event_time``, ``id``)."""
    looked = cache_lookup(cache_keys(windows), writes, ttl, rows_per_slice)
    kind = roads.schema["placeId"].dataType
    point = F.from_json("value", CACHED_POINT)
    hits = looked.where("value IS NOT NULL").withColumn("_p", point).select(
        "id", "deviceId", "event_time", "location", F.col("_p.place_id").cast(kind).alias("placeId"),
        F.col("_p.location.latitude").alias("road_latitude"), F.col("_p.location.longitude").alias("road_longitude"))
    misses = snap_windows(looked.where("value IS NULL").drop("key", "value", "written_at"), roads, rows_per_slice)
    return hits.withColumn("cached", F.lit(True)).unionByName(misses.withColumn("cached", F.lit(False)))


def with_assigned_limit(routes: DataFrame) -> DataFrame:
    return routes.withColumn("SpeedLimit", posted_limit_for(F.col("placeId")))


def with_limit(routes: DataFrame, posted: DataFrame | None = None) -> DataFrame:
    """The place's posted limit (``placeId``, ``speedLimit``); one chosen by the place where none is posted."""
    return with_assigned_limit(routes) if posted is None else speed_limit_lookup(routes, posted)


def route_messages(routes: DataFrame) -> DataFrame:
    """What is published per route."""
    return routes.select(
        F.col("deviceId").alias("deviceID"), F.col("placeId").cast("string").alias("placeId"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "SpeedLimit",
    )


def cache_writes(routes: DataFrame) -> DataFrame:
    """What is cached per route: under the place of the last fix, the first snapped point as JSON."""
    key = route_key(F.get("location", F.lit(0)), F.get("location", F.lit(1)))
    point = F.to_json(F.struct(
        F.struct(F.col("road_latitude").alias("latitude"), F.col("road_longitude").alias("longitude")).alias("location"),
        F.col("placeId").cast("string").alias("place_id"), F.lit(0).alias("original_index"),
    ))
    return routes.select(key.alias("key"), point.alias("value"), "event_time", "id")


def arrived(latitude: Column, longitude: Column, destination: tuple[float, float]) -> Column:
    """At or beyond the destination, for a journey to the north-west."""
    return (latitude >= destination[0]) & (longitude <= destination[1])


def journey_until_arrival(fixes: DataFrame, destination: tuple[float, float],
                          rows_per_slice: int | None = None) -> DataFrame:
    """Fixes of each device before its first arrival. The arrival is an aggregate, so no device is sorted."""
    place = F.col("location")
    there = arrived(F.get(place, F.lit(0)), F.get(place, F.lit(1)), destination)
    order = F.struct("event_time", "id")
    first = fixes.where(there).groupBy("deviceId").agg(F.min(order).alias("_arrival"))
    rows = lookup(fixes, first, ["deviceId"], ["id"], rows_per_slice)
    return rows.where(F.col("_arrival").isNull() | (order < F.col("_arrival"))).drop("_arrival")
