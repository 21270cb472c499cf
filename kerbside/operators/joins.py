"""Interval, as-of, nearest-point and lookup joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from kerbside.functions.rules import posted_limit_for
from kerbside.operators.timeline import Timeline, micros, spread, union_all


def interval_join(gps: DataFrame, limits: DataFrame, tolerance: str = "5 minutes", how: str = "left",
                  rows_per_slice: int | None = None, salts: int = 1) -> DataFrame:
    """Every (fix, speed limit) pair of one device at most ``tolerance`` apart; ``left`` keeps unmatched fixes.

    Works on two batch frames or two streams. A stream join is Spark's own symmetric join, which compares a row with all that
    the other side holds under its key; so the key is the device and a stretch of time of four tolerances, a fix stays in the one it
    lies in, and a limit is copied to the one or two it can reach (``held_once`` tells which copy counts). A stream cannot be counted
    beforehand, so ``salts`` says over how many tasks one device's fixes are spread (its limits, which are fewer, are copied
    to each). Choose it before the first checkpoint. In batch the time axis is
    cut into buckets twice the tolerance wide and the bucket joins the key, so a device is spread over as many tasks as
    it has buckets; a bucket above the row bound is salted as well. Each limit is copied to the two buckets it can reach
    (three if it hits an edge), each fix stays in its one bucket.
    """
    brought = {c.lower() for c in limits.columns}
    gps = gps.drop(*[c for c in gps.columns if c.lower() in brought])  # a limit sent with the fix gives way to the joined one
    reach = micros(tolerance)
    if gps.isStreaming:
        width, times = _stretch(tolerance), F.unix_micros("event_time_speed")
        away = F.expr(f"INTERVAL {tolerance}")
        near = F.col("event_time").between(F.col("event_time_speed") - away, F.col("event_time_speed") + away)
        same = (F.col("deviceId") == F.col("deviceId_sl")) & (F.col("_stretch") == F.col("_stretch_sl"))
        fixes = gps.withColumn("_stretch", F.floor(F.unix_micros("event_time") / width))
        copies = limits.withColumn("_stretch_sl", F.explode(F.sequence(F.floor((times - reach) / width), F.floor((times + reach) / width))))
        if salts > 1:
            fixes = fixes.withColumn("_salt", F.pmod(F.xxhash64(*_spread_columns(gps), "event_time"), F.lit(salts)).cast("int"))
            copies = copies.withColumn("_salt_sl", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            same = same & (F.col("_salt") == F.col("_salt_sl"))
        return fixes.join(copies, same & near, how).drop("_stretch", "_stretch_sl", "_salt", "_salt_sl")

    width = 2 * reach
    fixes = gps.withColumn("_t", F.unix_micros("event_time"))
    fixes = fixes.withColumns({"_device": F.col("deviceId"), "_bucket": F.floor(F.col("_t") / width)})
    times = F.unix_micros("event_time_speed")
    copies = limits.where(F.col("deviceId_sl").isNotNull()).withColumns({
        "_device": F.col("deviceId_sl"),
        "_s": times,
        "_bucket": F.explode(F.sequence(F.floor((times - reach) / width), F.floor((times + reach) / width))),
    })
    fixes, copies, keys = spread(fixes, copies, ["_device", "_bucket"], ["_t", *_spread_columns(gps)], rows_per_slice)
    near = F.abs(F.col("_t") - F.col("_s")) <= reach
    condition = near
    for key in keys:
        condition = condition & (F.col(f"f.{key}") == F.col(f"l.{key}"))
    joined = fixes.alias("f").join(copies.alias("l"), condition, how)
    return joined.select(*[f"f.{c}" for c in gps.columns], *[f"l.{c}" for c in limits.columns])


def _stretch(tolerance: str) -> int:
    return max(4 * micros(tolerance), 1)


def held_once(tolerance: str, row: str = "value") -> Column:
    """Whether a limit in the state of a stream's ``interval_join`` stands in the stretch of its own time: one copy of each does."""
    return F.floor(F.unix_micros(f"{row}.event_time_speed") / _stretch(tolerance)) == F.col(f"{row}._stretch_sl")


def _spread_columns(frame: DataFrame) -> list[str]:
    return [c for c in ("id",) if c in frame.columns]


def _descending(frame: DataFrame, name: str) -> Column:
    """A column that ascends where ``name`` descends, for numbers, times, booleans and text."""
    kind = frame.schema[name].dataType
    if isinstance(kind, NumericType):
        return -F.col(name)
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return -F.unix_micros(F.col(name).cast("timestamp"))
    # hexadecimal digits turned round; the end sorts after every digit, as a longer text sorts before its beginning now
    return F.concat(F.translate(F.hex(F.col(name).cast("string")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def _ties(frame: DataFrame, ties: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """The tie columns the frame has; messages without any are ordered by what is wanted of them."""
    return [c for c in ties if c in frame.columns] or list(wanted)


def as_of_many(left: DataFrame, sides: Mapping[str, tuple[DataFrame, Sequence[str]]], keys: Sequence[str], at: Column,
               ties: Sequence[str] = (), forward: bool = False, rows_per_slice: int | None = None) -> DataFrame:
    """``left`` with, per side, a struct of the latest row of its key at or before it (``forward``: the next after it).

    ``sides`` maps a name to a frame and the columns wanted; the struct also holds ``right_at``, the time of the row. ``at``
    is the event time, evaluated on every frame. All frames are united and one running window carries the structs: a
    single shuffle for any number of sides, no pairs, and a hot key is split by time. Of several rows at one instant the
    greatest by ``ties`` counts (``forward``: the smallest); ties may be numbers or text, and a side without any
    of these columns is ordered by the columns wanted. A null key matches nothing.
    """
    stamp = (F.unix_micros(at) * (-1 if forward else 1)).alias("_t")
    # at one instant a backward match sees the other side's row; a forward match must not
    spine = left.select(*keys, stamp, F.lit(0 if forward else 1).alias("_side"), F.struct(*left.columns).alias("_row"))
    others, names = [], set()
    for number, (name, (frame, wanted)) in enumerate(sides.items()):
        placed = []
        for c in _ties(frame, ties, wanted):
            names.add(f"_tie_{number}_{c}")
            placed.append((_descending(frame, c) if forward else F.col(c)).alias(f"_tie_{number}_{c}"))
        others.append(frame.na.drop(subset=list(keys)).select(
            *keys, stamp, F.lit(1 if forward else 0).alias("_side"), *placed,
            F.struct(at.alias("right_at"), *wanted).alias(f"_load_{name}")))
    line = Timeline(union_all([*others, spine]), keys, F.col("_t"), ["_side", *sorted(names)], rows_per_slice)
    found = line.last_known(**{f"_found_{name}": F.col(f"_load_{name}") for name in sides}).done()
    return found.where(F.col("_row").isNotNull()).select("_row.*", *[F.col(f"_found_{n}").alias(n) for n in sides])


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: Column, payload: Sequence[str],
          ties: Sequence[str] = (), max_age: str | None = None, forward: bool = False,
          rows_per_slice: int | None = None) -> DataFrame:
    """``left`` with ``right_at`` and ``payload`` of one side's matching row, at most ``max_age`` away (see ``as_of_many``).

    Columns of ``left`` named as one of these give way to them.
    """
    brought = {c.lower() for c in ("right_at", *payload)}
    left = left.drop(*[c for c in left.columns if c.lower() in brought])
    found = as_of_many(left, {"_found": (right, payload)}, keys, at, ties, forward, rows_per_slice)
    if max_age:
        age = F.abs(F.unix_micros(at) - F.unix_micros(F.col("_found.right_at")))
        found = found.withColumn("_found", F.when(age <= micros(max_age), F.col("_found")))
    return found.select(*left.columns, "_found.right_at", *[f"_found.{c}" for c in payload])


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread_by: Sequence[str],
           rows_per_slice: int | None = None) -> DataFrame:
    """Left join to a table with one row per key. Spark broadcasts the table if its size allows; else hot keys are salted."""
    left, right, on = spread(rows, table, keys, spread_by, rows_per_slice)
    return left.join(right, on, "left").drop("_salt")


def speed_limit_lookup(routes: DataFrame, posted: DataFrame, rows_per_slice: int | None = None) -> DataFrame:
    """Posted limit of each place; a place without one gets a limit chosen by its key."""
    rows = lookup(routes, posted.select("placeId", F.col("speedLimit").alias("_posted")), ["placeId"], ["id"],
                  rows_per_slice)
    return rows.withColumn("SpeedLimit", F.coalesce("_posted", posted_limit_for(F.col("placeId")))).drop("_posted")


EARTH_METRES = 6_371_008.8


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lng = F.sin((F.radians(lng2) - F.radians(lng1)) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return F.lit(2 * EARTH_METRES) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


METRES_PER_DEGREE = 111_194.9


def _bands(latitude: Column, size: float) -> Column:
    return F.floor((latitude + 90.0) / size)


def _columns(band: Column, size: float) -> Column:
    """Cells around the globe in a band of latitude: each at least ``size`` degrees of a great circle wide, all alike."""
    edge = F.greatest(F.abs(band * size - 90.0), F.abs((band + 1) * size - 90.0))
    width = F.cos(F.radians(F.least(edge, F.lit(90.0))))
    return F.greatest(F.floor(360.0 * width / size), F.lit(1)).cast("bigint")


def _near_roads(places: DataFrame, roads: DataFrame, max_metres: float, rows_per_slice: int | None,
                along: Sequence[str] = ()) -> tuple[DataFrame, Column]:
    """Distinct places next to the road points around them, and how far apart the two are (see ``snap_to_road``)."""
    size = max_metres * 1.001 / METRES_PER_DEGREE
    located = "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"
    todo = places.select("latitude", "longitude").where(located).distinct()
    spots = roads.where(located).groupBy("latitude", "longitude").agg(F.min(F.struct("placeId", *along)).alias("_p")) \
        .select("latitude", "longitude", "_p.*")

    def cell(band: Column) -> Column:
        count = _columns(band, size)
        return F.least(F.floor((F.col("longitude") + 180.0) / 360.0 * count), count - 1)

    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    near = todo.withColumn("_y", F.explode(F.transform(steps, lambda d: _bands(F.col("latitude"), size) + d)))
    around = F.array_distinct(F.transform(steps, lambda d: F.pmod(cell(F.col("_y")) + d, _columns(F.col("_y"), size))))
    near = near.withColumn("_x", F.explode(around))
    grid = spots.withColumn("_y", _bands(F.col("latitude"), size)).withColumn("_x", cell(F.col("_y"))) \
        .withColumnsRenamed({"latitude": "_rlat", "longitude": "_rlng"})
    left, right, keys = spread(near, grid, ["_y", "_x"], ["latitude", "longitude"], rows_per_slice)
    metres = haversine(F.col("latitude"), F.col("longitude"), F.col("_rlat"), F.col("_rlng"))
    return left.join(right, keys).where(metres <= max_metres), metres


def road_candidates(places: DataFrame, roads: DataFrame, max_metres: float, most: int, along: Sequence[str] = (),
                    rows_per_slice: int | None = None) -> DataFrame:
    """Each distinct place with its ``most`` nearest road points at most ``max_metres`` away, in the order of ``placeId``:
    ``candidates``, structs of placeId, latitude, longitude, distance_m and the columns ``along``. Spark keeps ``most``
    rows per place and task before it shuffles them."""
    near, metres = _near_roads(places, roads, max_metres, rows_per_slice, along)
    order = Window.partitionBy("latitude", "longitude").orderBy(metres, "placeId")
    kept = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most)
    point = F.struct("placeId", F.col("_rlat").alias("latitude"), F.col("_rlng").alias("longitude"), metres.alias("distance_m"), *along)
    return kept.groupBy("latitude", "longitude").agg(F.sort_array(F.collect_list(point)).alias("candidates"))


def snap_to_road(places: DataFrame, roads: DataFrame, max_metres: float = 5_000.0,
                 rows_per_slice: int | None = None) -> DataFrame:
    """Nearest road point at most ``max_metres`` away of each distinct (latitude, longitude) in ``places``: ``placeId`` and
    ``distance_m``. A place without one is left out.

    Copies collapse first on both sides: equal places are looked up once, of road points at one spot the smallest
    ``placeId`` counts. The globe is cut into bands of latitude and each band into cells, both at least ``max_metres`` wide, and
    cell numbers run on across the date line; so the 3x3 cells around a place hold all there is to find, in one join.
    Candidates are reduced to the nearest inside the joining task; a cell with very many places is salted, one with very
    many roads is split by adaptive execution.
    """
    near, metres = _near_roads(places, roads, max_metres, rows_per_slice)
    candidate = F.struct(metres.alias("distance_m"), "placeId", F.col("_rlat").alias("road_latitude"),
                         F.col("_rlng").alias("road_longitude"))
    best = near.groupBy("latitude", "longitude").agg(F.min(candidate).alias("_best"))
    return best.select("latitude", "longitude", "_best.*")
