"""Hot keys: the sliced, salted forms must return what the plain forms and brute force return."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.operators import cache, joins, metrics as m, state, windows
from kerbside.operators.timeline import Timeline, hot_keys, numbered, spread, split_points

START = datetime(2024, 1, 1)
SLICE = 7


def rows(seed, n=240, devices=5, ties=True):
    """One device holds most rows; with ``ties`` several rows share an instant."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        device = "hot" if rng.random() < 0.6 else f"d{rng.randrange(devices)}"
        second = rng.randrange(n // 2 if ties else n * 50)
        out.append((i, device, START + timedelta(seconds=second), float(rng.randrange(20, 140)), rng.choice(["a", "b", None])))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "id long, deviceId string, event_time timestamp, speed double, tag string")


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def both(spark, data, step, *columns):
    df = frame(spark, data)
    plain, sliced = step(df, None), step(df, SLICE)
    want = collected(plain, "id", *columns)
    assert want and collected(sliced, "id", *columns) == want


def line(df, bound):
    return Timeline(df, ["deviceId"], F.unix_micros("event_time"), ["id"], bound)


def test_hot_device_is_cut_into_bounded_slices(spark):
    data = rows(1, ties=False)
    made = line(frame(spark, data), SLICE)
    assert made.sliced
    sizes = made.rows.where("deviceId = 'hot'").groupBy("_slice").count().collect()
    assert len(sizes) > 10 and max(r["count"] for r in sizes) <= 4 * SLICE
    assert not line(frame(spark, data), None).sliced


def test_split_points_are_sorted_and_only_for_hot_keys(spark):
    df = frame(spark, rows(2)).withColumn("at", F.unix_micros("event_time"))
    hot = {r["deviceId"] for r in hot_keys(df, ["deviceId"], 30)}
    points = {r["deviceId"]: r["_points"] for r in split_points(df, ["deviceId"], ["at", "id"], 30).collect()}
    assert set(points) == hot and all(p == sorted(p) for p in points.values())


def test_rows_of_one_instant_are_split_too(spark):
    """A third of all rows at the same instant of the same device."""
    data = rows(3) + [(1000 + i, "hot", START, 50.0 + i, "a") for i in range(120)]
    made = line(frame(spark, data), SLICE)
    assert max(r["count"] for r in made.rows.groupBy("deviceId", "_slice").count().where("deviceId = 'hot'").collect()) <= 4 * SLICE
    both(spark, data, lambda d, b: line(d, b).previous("before", F.col("speed"), 4).row_number("n").done(), "before", "n")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_last_known(spark, seed):
    both(spark, rows(seed), lambda d, b: line(d, b).last_known(seen=F.col("tag"), fast=F.when(F.col("speed") > 100, F.col("speed"))).done(),
         "seen", "fast")


@pytest.mark.parametrize("n", [1, 4])
def test_previous(spark, n):
    both(spark, rows(4), lambda d, b: line(d, b).previous("before", F.col("speed"), n).done(), "before")


def test_running_with_totals(spark):
    step = lambda d, b: line(d, b).running(totals=True, s="IF(speed > 60, 1L, 0L)").done()
    both(spark, rows(5), step, "s", "s_total")


def test_row_number(spark):
    both(spark, rows(6), lambda d, b: line(d, b).row_number("n").done(), "n")


def test_dedupe_and_braking_and_trips(spark):
    data = [(i, d, t, s % 11, g or "a") for i, d, t, s, g in rows(7)]
    alerts = lambda d: d.withColumnsRenamed({"speed": "target_speed", "tag": "action"})
    both(spark, data, lambda d, b: windows.alert_dedupe(alerts(d), rows_per_slice=b), "suppressed")
    both(spark, rows(8), lambda d, b: m.hard_braking(d, 10.0, "30 seconds", b), "speed_before", "speed_drop")
    both(spark, rows(9), lambda d, b: m.with_trip(d, "2 seconds", b), "trip_start")


def test_dedupe_against_brute_force(spark):
    data = sorted([(i, d, t, s % 11, g or "a") for i, d, t, s, g in rows(10)], key=lambda r: (r[1], r[2], r[0]))
    history, want = {}, {}
    for i, device, _, target, action in data:
        recent = history.setdefault(device, [])
        want[i] = any(a == action and abs(t - target) < 2 for a, t in recent[-4:])
        recent.append((action, target))
    df = frame(spark, data).withColumnsRenamed({"speed": "target_speed", "tag": "action"})
    got = {r["id"]: r["suppressed"] for r in windows.alert_dedupe(df, rows_per_slice=SLICE).collect()}
    assert got == want and any(want.values()) and not all(want.values())


@pytest.mark.parametrize("gap", ["1 second", "3 seconds", "20 seconds"])
@pytest.mark.parametrize("seed", [11, 12])
def test_throttle_against_brute_force(spark, gap, seed):
    data = rows(seed)
    seconds = int(gap.split()[0])
    last, want = {}, {}
    for i, device, at, *_ in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        want[i] = device not in last or (at - last[device]).total_seconds() >= seconds
        if want[i]:
            last[device] = at
    for bound in (None, SLICE):
        got = {r["id"]: r["emitted"] for r in windows.throttle(frame(spark, data), gap, bound).collect()}
        assert got == want


def test_exit_table_gives_the_last_emission_of_every_entry_state():
    rng = np.random.default_rng(3)
    for _ in range(200):
        times = np.sort(rng.integers(0, 60, rng.integers(1, 30)))
        gap = int(rng.integers(1, 15))
        entry, last = windows.exit_table(times, gap)
        for before in range(int(times[0]) - gap - 2, int(times[0]) + 1):
            at = np.searchsorted(entry, before + gap, "left")
            got = last[at] if at < len(entry) else before
            assert got == windows.emit_flags(times, gap, before)[1]


@pytest.mark.parametrize("per_device", [True, False])
def test_count_windows(spark, per_device):
    data = rows(13)
    placed = lambda d: d.withColumn("location", F.array("speed", "speed"))
    both(spark, data, lambda d, b: windows.count_windows(placed(d), 3, per_device, b), "fix_ids", "deviceId")
    ordered = sorted(data, key=lambda r: (r[2], r[0]))
    if not per_device:
        got = windows.count_windows(placed(frame(spark, data)), 3, False, SLICE).orderBy("window_no").collect()
        want = [[r[0] for r in ordered[i:i + 3]] for i in range(0, len(ordered) // 3 * 3, 3)]
        assert [r["fix_ids"] for r in got] == want


def sides(seed):
    gps, other = rows(seed), rows(seed + 100, n=120)
    return gps, [(i + 1000, d, t, float(int(s) // 30 * 30), g) for i, d, t, s, g in other]


@pytest.mark.parametrize("forward", [False, True])
def test_as_of_against_brute_force(spark, forward):
    gps, other = sides(20)
    want = []
    for i, d, t, *_ in gps:
        if forward:
            found = min(((x[2], x[0], x[3]) for x in other if x[1] == d and x[2] > t), default=None)
        else:
            found = max(((x[2], x[0], x[3]) for x in other if x[1] == d and x[2] <= t), default=None)
        want.append((i, found[2] if found else None))
    right = frame(spark, other).withColumnRenamed("speed", "value")
    for bound in (None, SLICE):
        got = joins.as_of(frame(spark, gps), right, ["deviceId"], F.col("event_time"), ["value"], ["id"], None, forward, bound)
        assert collected(got, "id", "value") == sorted(want, key=repr)


@pytest.mark.parametrize("forward", [False, True])
def test_as_of_with_text_ids_and_null_keys(spark, forward):
    """Ties of text order as text; a null key matches nothing, however many rows have it."""
    base = [(i, None if i % 4 == 0 else f"d{i % 3}", START + timedelta(seconds=i % 9), float(i), None) for i in range(90)]
    kind = "id string, deviceId string, event_time timestamp, speed double, tag string"
    named = lambda data: spark.createDataFrame([(f"{i % 13:x}-{i}", *r) for i, *r in data], kind)
    left, right = base[:40], base[40:]
    want = []
    for i, device, at, *_ in left:
        there = [(x[2], f"{x[0] % 13:x}-{x[0]}", x[3]) for x in right
                 if device and x[1] == device and (x[2] > at if forward else x[2] <= at)]
        best = (min if forward else max)(there, default=(None, None, None))
        want.append((f"{i % 13:x}-{i}", best[2]))
    for bound in (None, SLICE):
        got = joins.as_of(named(left), named(right).withColumnRenamed("speed", "value"), ["deviceId"], F.col("event_time"), ["value"],
                          ["id"], None, forward, bound)
        assert collected(got, "id", "value") == sorted(want, key=repr)


def test_one_order_over_all_rows(spark):
    data = rows(60) + [(5000, None, None, None, None)]
    got = numbered(frame(spark, data), "n", [F.col("event_time"), F.col("id")]).collect()
    order = sorted(data, key=lambda r: (r[2] is not None, r[2] or START, r[0]))
    assert [r["id"] for r in sorted(got, key=lambda r: r["n"])] == [r[0] for r in order]
    assert sorted(r["n"] for r in got) == list(range(1, len(data) + 1))


def test_device_state(spark):
    def step(df, bound):
        return state.device_state([df.withColumn("topic", F.lit("t"))], ["speed", "tag"], bound)

    both(spark, rows(21), step, "speed", "tag")


def limit_frame(spark, data):
    return frame(spark, data).select("id", "deviceId", "event_time", F.col("speed").alias("SpeedLimit"))


def pairs(gps, limits, seconds):
    return [(g, x) for g in gps for x in limits if g[1] == x[1] and abs((g[2] - x[2]).total_seconds()) <= seconds]


@pytest.mark.parametrize("seconds", [1, 7, 60])
@pytest.mark.parametrize("many", [False, True])
def test_overspeed_metrics_against_all_pairs(spark, seconds, many):
    """Few limit values and one per record; whole and spread. Limits that are no number and null devices are in no pair."""
    gps, limits = sides(30 + seconds)
    if many:
        limits = [(i, d, t, v + i / 1000, g) for i, d, t, v, g in limits]
    want = {}
    for g, x in pairs(gps, limits, seconds):
        if g[3] > x[3]:
            minute = g[2].replace(second=0)
            key = (g[1], f"{minute.isoformat()}/{(minute + timedelta(minutes=1)).isoformat()}")
            n, total, top = want.get(key, (0, 0.0, 0.0))
            want[key] = (n + 1, total + g[3] - x[3], max(top, g[3] - x[3]))
    odd = [(9000 + i, gps[i][1], gps[i][2], v, None) for i, v in enumerate([float("nan"), float("inf"), float("-inf"), None])]
    nameless = [(9100 + i, None, START, 50.0 + i, None) for i in range(20)]
    for bound in (None, SLICE):
        got = m.overspeed_metrics(frame(spark, gps + nameless), limit_frame(spark, limits + odd + nameless), f"{seconds} seconds", "1 minute", bound)
        found = {(r["deviceId"], r["period"]): r for r in got.collect()}
        assert set(found) == set(want)
        for key, (n, total, top) in want.items():
            assert found[key]["overspeed_events"] == n and found[key]["max_speed_over_limit"] == pytest.approx(top)
            assert found[key]["avg_speed_over_limit"] == pytest.approx(total / n)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_join_against_all_pairs(spark, how):
    gps, limits = sides(40)
    want = [(g[0], x[0]) for g, x in pairs(gps, limits, 5)]
    if how == "left":
        matched = {g for g, _ in want}
        want += [(g[0], None) for g in gps if g[0] not in matched]
    right = limit_frame(spark, limits).select(
        F.col("id").alias("limit_id"), F.col("deviceId").alias("deviceId_sl"), "SpeedLimit", F.col("event_time").alias("event_time_speed"))
    for bound in (None, SLICE):
        got = joins.interval_join(frame(spark, gps), right, "5 seconds", how, bound)
        assert collected(got, "id", "limit_id") == sorted(want, key=repr)


def test_spread_keeps_an_equi_join(spark):
    left = frame(spark, rows(50))
    right = spark.createDataFrame([("hot", 1), ("d1", 2), ("none", 3)], "deviceId string, v int")
    a, b, keys = spread(left, right, ["deviceId"], ["id"], SLICE)
    assert "_salt" in keys and a.where("deviceId = 'hot'").select("_salt").distinct().count() > 5
    want = collected(left.join(right, "deviceId", "left"), "id", "v")
    assert collected(a.join(b, keys, "left"), "id", "v") == want
    assert collected(joins.lookup(left, right, ["deviceId"], ["id"], SLICE), "id", "v") == want


def test_cache_lookup_with_hot_key(spark):
    gps, other = sides(60)
    reads = frame(spark, gps).select(F.col("deviceId").alias("key"), "id", "event_time")
    writes = frame(spark, other).select(F.col("deviceId").alias("key"), F.col("speed").cast("string").alias("value"), "id", "event_time")
    want = []
    for i, d, t, *_ in gps:
        held = max(((x[2], x[0], str(x[3])) for x in other if x[1] == d and x[2] <= t), default=None)
        alive = held and (t - held[0]).total_seconds() < 3
        want.append((i, held[2] if alive else None))
    for bound in (None, SLICE):
        assert collected(cache.cache_lookup(reads, writes, "3 seconds", bound), "id", "value") == sorted(want, key=repr)


def test_nearest_road_against_brute_force(spark):
    """Also across the date line, near a pole and with roads too far away."""
    rng = random.Random(70)
    places = [(51 + rng.random(), -1 + rng.random()) for _ in range(60)] + [(53.0, 2.0), (10.0, 180.0), (10.0, -180.0)]
    places += [(-17 + rng.random() / 9, rng.choice([-1, 1]) * (180 - rng.random() / 20)) for _ in range(40)]
    places += [(89.96 + rng.random() / 30, rng.uniform(-180, 180)) for _ in range(20)] + [(90.0, 5.0), (-90.0, 0.0)]
    roads = [(k, 51 + rng.random() * (0.05 if k % 2 else 1), -1 + rng.random()) for k in range(300)]
    roads += [(400 + k, -17 + rng.random() / 9, rng.choice([-1, 1]) * (180 - rng.random() / 20)) for k in range(60)]
    roads += [(500 + k, 89.96 + rng.random() / 30, rng.uniform(-180, 180)) for k in range(30)]
    p = spark.createDataFrame(places * 3 + [(None, 1.0), (95.0, 1.0)], "latitude double, longitude double")
    r = spark.createDataFrame(roads + [(k + 1000, a, b) for k, a, b in roads[:50]], "placeId long, latitude double, longitude double")

    def metres(a, b):
        la, lo, lb, ln = map(np.radians, (a[0], a[1], b[0], b[1]))
        h = np.sin((lb - la) / 2) ** 2 + np.cos(la) * np.cos(lb) * np.sin((ln - lo) / 2) ** 2
        return 2 * joins.EARTH_METRES * np.arcsin(np.sqrt(h))

    for bound, most in ((None, 5000.0), (SLICE, 800.0)):
        near = {q: min((metres(q, x[1:]), x[0]) for x in roads) for q in places}
        want = {q: k for q, (d, k) in near.items() if d <= most}
        assert 20 < len(want) < len(near)
        got = {(x["latitude"], x["longitude"]): x["placeId"] for x in joins.snap_to_road(p, r, most, bound).collect()}
        assert got == want
