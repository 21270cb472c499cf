"""Paths of fixes matched to roads as a hidden Markov model.

A fix was seen somewhere near the road point where the vehicle was: the further off, the less likely. From one fix to the next
the way along the roads should be as long as the straight line between the fixes: a point of the same road lies as far as the
road runs, one of another road as far as the straight line and ``change_m`` for leaving the road. The most likely road points of
a whole path therefore stay on a road where single fixes are nearer to a parallel one.

Paths are count windows, so what one path takes is bounded by its size and the number of candidates per fix, however long
a device drives. Candidates are looked up once per distinct place; the decoding runs over all paths of an Arrow batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from kerbside.operators.joins import EARTH_METRES, lookup, road_candidates

#: Costs are whole numbers of this fraction, so that sums are exact and ties are ties.
UNIT = 1_000
NEVER = 1 << 50


def metres_between(lat1: np.ndarray, lng1: np.ndarray, lat2: np.ndarray, lng2: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin((np.radians(lng2) - np.radians(lng1)) / 2) ** 2
    return 2 * EARTH_METRES * np.arcsin(np.minimum(1.0, np.sqrt(h)))


def cheapest(emission: np.ndarray, step: np.ndarray) -> np.ndarray:
    """For costs (path, time, candidate) and (path, time, candidate, next candidate): the candidate at each time of the cheapest
    way through; of equally cheap ways the one with the first candidates."""
    paths, times, _ = emission.shape
    rest, chosen = emission.copy(), np.zeros((paths, times), np.int64)
    for t in range(times - 2, -1, -1):
        rest[:, t] += (step[:, t] + rest[:, t + 1][:, None, :]).min(2)
    every = np.arange(paths)
    chosen[:, 0] = rest[:, 0].argmin(1)
    for t in range(1, times):
        chosen[:, t] = (step[every, t - 1, chosen[:, t - 1]] + rest[:, t]).argmin(1)
    return chosen


def decode(fixes: list[list], sigma: float, beta: float, change_m: float) -> np.ndarray:
    """The candidate chosen for each fix of each path (path, time); -1 for a fix without candidates, which the path skips over."""
    times = max(map(len, fixes))
    width = max(1, max(len(f["candidates"]) for path in fixes for f in path))
    shape = (len(fixes), times, width)
    lat, lng, away, along = (np.zeros(shape) for _ in range(4))
    road, used = np.zeros(shape, np.int64), np.zeros(shape, bool)
    at = np.zeros((*shape[:2], 2))
    for p, path in enumerate(fixes):
        for t, fix in enumerate(path):
            at[p, t] = fix["latitude"], fix["longitude"]
            for c, x in enumerate(fix["candidates"]):
                lat[p, t, c], lng[p, t, c], away[p, t, c], road[p, t, c], along[p, t, c] = x["latitude"], x["longitude"], x["distance_m"], x["roadId"], x["along_m"]
                used[p, t, c] = True
    nowhere = ~used.any(2)
    emission = np.where(used, np.rint(UNIT * 0.5 * (away / sigma) ** 2), NEVER).astype(np.int64)
    emission[nowhere] = 0
    straight = metres_between(at[:, :-1, 0], at[:, :-1, 1], at[:, 1:, 0], at[:, 1:, 1])
    a, b = (slice(None), slice(None, -1), slice(None), None), (slice(None), slice(1, None), None, slice(None))
    route = np.where(road[a] == road[b], np.abs(along[a] - along[b]), metres_between(lat[a], lng[a], lat[b], lng[b]) + change_m)
    step = np.rint(UNIT * np.abs(route - straight[:, :, None, None]) / beta).astype(np.int64)
    step[nowhere[:, :-1] | nowhere[:, 1:]] = 0
    return np.where(nowhere, -1, cheapest(emission, step))


def snap_path(windows: DataFrame, roads: DataFrame, max_metres: float = 200.0, most: int = 8, sigma: float = 20.0, beta: float = 100.0,
              change_m: float = 500.0, rows_per_slice: int | None = None) -> DataFrame:
    """The road point of every fix of every path: (deviceId, window_no, step, fix_id, placeId, roadId, distance_m).

    ``windows`` are count windows (``path``, ``fix_ids``). ``roads`` needs placeId, latitude, longitude, ``roadId`` and ``along_m``,
    the position along the road. A fix has at most ``most`` candidates, the nearest at most ``max_metres`` away; without any, its
    placeId is null and the path goes on after it. Of equally likely paths the one with the smaller placeIds counts, from the first fix on.
    """
    fixes = windows.select("deviceId", "window_no", F.posexplode(F.arrays_zip("path", "fix_ids")).alias("step", "_fix")).select(
        "deviceId", "window_no", "step", F.col("_fix.fix_ids").alias("id"), F.get("_fix.path", F.lit(0)).alias("latitude"),
        F.get("_fix.path", F.lit(1)).alias("longitude"))
    known = road_candidates(fixes, roads, max_metres, most, ["roadId", "along_m"], rows_per_slice)
    found = lookup(fixes, known, ["latitude", "longitude"], ["id"], rows_per_slice)
    fix = F.struct("step", "id", "latitude", "longitude", F.coalesce("candidates", F.array().cast(known.schema["candidates"].dataType)).alias("candidates"))
    paths = found.groupBy("deviceId", "window_no").agg(F.sort_array(F.collect_list(fix)).alias("fixes"))

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 1_000):
                part = batch.iloc[start:start + 1_000]
                held = [list(f) for f in part["fixes"]]
                chosen = decode(held, sigma, beta, change_m)
                out = []
                for device, number, path, picks in zip(part["deviceId"], part["window_no"], held, chosen):
                    for fix, pick in zip(path, picks):
                        point = fix["candidates"][pick] if pick >= 0 else {}
                        out.append((device, number, fix["step"], fix["id"], *(point.get(c) for c in ("placeId", "roadId", "distance_m"))))
                rows = pd.DataFrame(out, columns=["deviceId", "window_no", "step", "fix_id", "placeId", "roadId", "distance_m"])
                yield rows.astype({"roadId": "Int64", **({"placeId": "Int64"} if whole else {})})

    place = roads.schema["placeId"].dataType.simpleString()
    whole = place in ("bigint", "int")
    ids = fixes.schema["id"].dataType.simpleString()
    return paths.mapInPandas(match, f"deviceId string, window_no long, step int, fix_id {ids}, placeId {place}, roadId long, distance_m double")
