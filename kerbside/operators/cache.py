"""Route cache: writes that expire, and reads that respect the expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.operators.joins import as_of
from kerbside.operators.timeline import micros

TIME_TO_LIVE = "3600 seconds"


def route_key(latitude: Column, longitude: Column) -> Column:
    return F.concat(F.lit("route:"), latitude.cast("string"), F.lit(":"), longitude.cast("string"))


def expiry(at: Column, ttl: str = TIME_TO_LIVE) -> Column:
    return F.timestamp_micros(F.unix_micros(at) + micros(ttl))


def cache_write(writes: DataFrame, ttl: str = TIME_TO_LIVE) -> DataFrame:
    """Content of the cache after all writes (``key``, ``value``, ``event_time``, ``id``): a later write replaces the
    value and restarts its time to live. Combines before the shuffle, so a key written often does no harm."""
    latest = writes.groupBy("key").agg(F.max(F.struct("event_time", "id", "value")).alias("w"))
    return latest.select(
        "key", F.col("w.value").alias("value"), F.col("w.event_time").alias("written_at"),
        expiry(F.col("w.event_time"), ttl).alias("expires_at"),
    )


def cache_lookup(reads: DataFrame, writes: DataFrame, ttl: str = TIME_TO_LIVE,
                 rows_per_slice: int | None = None) -> DataFrame:
    """Each read with the value its key has at that time, null on a miss. A write at the same instant is seen; a value
    is gone at the instant it expires."""
    found = as_of(reads, writes, ["key"], F.col("event_time"), ["value"], ["id"], rows_per_slice=rows_per_slice)
    alive = F.unix_micros("event_time") - F.unix_micros("right_at") < micros(ttl)
    return found.withColumn("value", F.when(alive, F.col("value"))).withColumn(
        "written_at", F.when(alive, F.col("right_at"))
    ).drop("right_at")


def cache_hits(reads: DataFrame, writes: DataFrame, ttl: str = TIME_TO_LIVE,
               rows_per_slice: int | None = None) -> DataFrame:
    """Reads with ``hit``; only the misses need a road lookup."""
    return cache_lookup(reads, writes, ttl, rows_per_slice).withColumn("hit", F.col("written_at").isNotNull())
