"""Map matching against all ways through the candidates, and on a road next to another."""

import itertools
import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from kerbside.operators import joins, map_matching as mm
from kerbside.operators.windows import count_windows

BASE = datetime(2024, 1, 1)
GPS = "id long, deviceId string, event_time timestamp, location array<double>"
ROADS = "placeId long, latitude double, longitude double, roadId long, along_m double"


@pytest.mark.parametrize("seed", range(4))
def test_cheapest_is_the_first_of_all_ways(seed):
    rng = np.random.default_rng(seed)
    emission, step = rng.integers(0, 4, (20, 4, 3)), rng.integers(0, 4, (20, 3, 3, 3))
    got = mm.cheapest(emission.astype(np.int64), step.astype(np.int64))
    for p in range(20):
        cost = lambda way: sum(emission[p, t, c] for t, c in enumerate(way)) + sum(step[p, t, way[t], way[t + 1]] for t in range(3))  # noqa: E731,B023
        assert tuple(got[p]) == min(itertools.product(range(3), repeat=4), key=lambda w: (cost(w), w))


def two_roads():
    """Points every 100 metres or so on two parallel roads 40 metres apart."""
    step = 0.0009
    return [(100 * r + i, 51.0 + i * step, 0.0 + r * 0.00057, r, i * 100.1) for r in range(2) for i in range(12)]


def drive(offsets):
    """One fix per road point; ``offsets`` say how far towards the second road each is seen."""
    return [(i, "a", BASE + timedelta(seconds=i), [51.0 + i * 0.0009, o * 0.00057]) for i, o in enumerate(offsets)]


def test_a_path_stays_on_its_road_where_a_fix_is_nearer_to_another(spark):
    gps, roads = spark.createDataFrame(drive([0, 0.1, 0.6, 0.1, 0, 0.2]), GPS), spark.createDataFrame(two_roads(), ROADS)
    matched = mm.snap_path(count_windows(gps, 6), roads, 90.0).orderBy("step").collect()
    assert [r["placeId"] for r in matched] == [0, 1, 2, 3, 4, 5] and {r["roadId"] for r in matched} == {0}
    spot = gps.where("id = 2").selectExpr("location[0] AS latitude", "location[1] AS longitude")
    assert joins.snap_to_road(spot, roads, 90.0).first()["placeId"] == 102
    moved = mm.snap_path(count_windows(spark.createDataFrame(drive([0, 0, 0.95, 1, 1, 1]), GPS), 6), roads, 90.0, change_m=50.0).orderBy("step").collect()
    assert [r["roadId"] for r in moved] == [0, 0, 1, 1, 1, 1]


def brute(path, roads, max_metres, most, sigma, beta, change):
    def metres(a, b):
        return float(mm.metres_between(*map(np.float64, (*a, *b))))

    sets = []
    for at in path:
        near = sorted((metres(at, r[1:3]), r) for r in roads if metres(at, r[1:3]) <= max_metres)[:most]
        sets.append(sorted((r, d) for d, r in near) or [None])
    best = None
    for way in itertools.product(*sets):
        cost = sum(round(1000 * 0.5 * (x[1] / sigma) ** 2) for x in way if x)
        for (p, q), (x, y) in zip(zip(path, path[1:]), zip(way, way[1:])):
            if x and y:
                a, b = x[0], y[0]
                route = abs(a[4] - b[4]) if a[3] == b[3] else metres(a[1:3], b[1:3]) + change
                cost += round(1000 * abs(route - metres(p, q)) / beta)
        key = (cost, [x[0][0] if x else -1 for x in way])
        best = min(best or key, key)
    return [x if x >= 0 else None for x in best[1]]


@pytest.mark.parametrize("rows_per_slice", [None, 3])
def test_against_all_paths(spark, rows_per_slice):
    rng = random.Random(6)
    gps = [(i, f"d{i % 3}", BASE + timedelta(seconds=i), [51.0 + rng.random() * 0.01, rng.random() * 0.0006]) for i in range(48)]
    gps += [(90 + i, "far", BASE + timedelta(seconds=i), [51.0 if i != 2 else -20.0, 0.0]) for i in range(4)]
    roads = two_roads() + [(900, 51.0, 0.0, 5, 0.0)]
    windows = count_windows(spark.createDataFrame(gps, GPS), 4)
    matched = mm.snap_path(windows, spark.createDataFrame(roads, ROADS), 120.0, 3, change_m=80.0, rows_per_slice=rows_per_slice)
    got = {}
    for r in matched.collect():
        got.setdefault((r["deviceId"], r["window_no"]), {})[r["step"]] = r["placeId"]
    spots = {}
    for r in roads:  # of points at one spot the smallest counts
        spots[r[1:3]] = min(spots.get(r[1:3], r), r)
    for w in windows.collect():
        want = brute(w["path"], list(spots.values()), 120.0, 3, 20.0, 100.0, 80.0)
        own = got[w["deviceId"], w["window_no"]]
        assert [own[i] for i in range(4)] == want
    assert got["far", 0][2] is None


def test_no_fixes(spark):
    empty = count_windows(spark.createDataFrame([], GPS), 3)
    assert mm.snap_path(empty, spark.createDataFrame(two_roads(), ROADS)).count() == 0
