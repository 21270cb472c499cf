"""Overspeed metrics, trips, braking, alerts and the driver scorecard."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import rules
from kerbside.functions.text import period_label
from kerbside.operators.joins import as_of, interval_join
from kerbside.operators.timeline import Timeline, micros, spread, union_all

#: Limits that count: readers accept NaN and infinities where a number is due.
NUMBER = "SpeedLimit > double('-Infinity') AND SpeedLimit < double('Infinity')"


def usable(gps: DataFrame) -> DataFrame:
    """Fixes that can take part in a pair."""
    return gps.where("deviceId IS NOT NULL AND event_time IS NOT NULL AND speed IS NOT NULL AND NOT isnan(speed)")


def overspeed_totals(gps: DataFrame, limits: DataFrame, by: Sequence[str], tolerance: str = "5 minutes",
                     flag: str | None = None, rows_per_slice: int | None = None) -> DataFrame:
    """Count, sum and maximum of speed over limit, over all (fix, limit) pairs of a device at most ``tolerance`` apart.

    ``by`` are columns of ``gps`` to group on. With ``flag`` (a boolean column of ``gps``) also ``flagged_events``: the
    pairs whose fix carries the flag.

    The pairs are never formed. The time axis is cut into blocks as wide as the whole tolerance range, so the range of a
    fix is the end of one block and the start of the next. A block's limits are kept sorted, in runs of 1, 2, 4, ... by time
    and by value within a run; any beginning of the block is a few whole runs, in each of which a binary search
    and running sums give the number, sum and smallest of the limits below a speed. That is one shuffle by (device,
    block), and work that grows with the rows, however many limits a fix is near to and whatever
    their values. A block with very many fixes is spread, its limits copied. Limits that are no number exceed nothing.
    """
    reach = micros(tolerance)
    width = 2 * reach
    keep = list(dict.fromkeys([*by, *([flag] if flag else [])]))
    time = F.unix_micros("event_time")

    def blocked(rows: DataFrame) -> DataFrame:
        # exact: microseconds of this era fit the 53 bits of a double
        return rows.withColumn("_block", F.floor(F.col("_t") / width))

    posted = blocked(limits.where(f"deviceId IS NOT NULL AND event_time IS NOT NULL AND {NUMBER}")
                     .select(F.col("deviceId").alias("_device"), time.alias("_t"), F.col("SpeedLimit").alias("_limit")))
    # the start of a range excludes what lies before it, the end includes its instant
    ends = F.array(F.struct((time - reach).alias("t"), F.lit(True).alias("from")),
                   F.struct((time + reach).alias("t"), F.lit(False).alias("from")))
    probes = blocked(usable(gps).select(F.col("deviceId").alias("_device"), F.col("speed").alias("_speed"),
                                        F.struct(*keep).alias("_fix"), F.inline(ends).alias("_t", "_from")))
    probes, posted, keys = spread(probes, posted, ["_device", "_block"], ["_t", "_speed"], rows_per_slice)
    rows = union_all([posted, probes]).select(*keys, "_t", "_limit", "_speed", "_from", "_fix")
    kind = rows.schema["_fix"].dataType.simpleString()
    counted = (
        rows.repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(lambda batches: _count_below(batches, keys), f"_fix {kind}, _events long, _excess double, _worst double")
    )
    parts = counted.select("_fix.*", "_events", "_excess", "_worst")
    aggregates = [
        F.sum("_events").alias("overspeed_events"),
        F.sum("_excess").alias("total_speed_over_limit"),
        F.max("_worst").alias("max_speed_over_limit"),
    ]
    if flag:
        aggregates.append(F.sum(F.when(F.col(flag), F.col("_events")).otherwise(0)).alias("flagged_events"))
    return parts.groupBy(*by).agg(*aggregates)


def _count_below(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Limits and probes sorted by block -> per probe with such limits their number, excess and largest excess."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < 50_000:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        groups = _group_starts(rows, keys)
        if groups[-1]:  # the last block may go on
            yield from _answers(rows.slice(0, groups[-1]), groups[:-1])
            held = rows.slice(groups[-1]).to_batches()
        else:
            held = rows.to_batches()
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield from _answers(rows, _group_starts(rows, keys))


def _group_starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    changes = np.zeros(rows.num_rows, dtype=bool)
    changes[0] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        changes[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changes)


def _answers(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows.num_rows)))
    time, limit = rows.column("_t").to_numpy(), rows.column("_limit").to_numpy()
    is_limit = ~np.asarray(rows.column("_limit").is_null())
    at = np.flatnonzero(~is_limit)
    below = LimitsBelow(group[is_limit], time[is_limit], limit[is_limit].astype("float64"))
    speed = rows.column("_speed").to_numpy()[at].astype("float64")
    starting = rows.column("_from").to_numpy(zero_copy_only=False)[at].astype(bool)
    events, total, worst = below.query(group[at], time[at], starting, speed)
    hit = events > 0
    if hit.any():
        out = rows.take(pa.array(at[hit])).select(["_fix"])
        for name, values in (("_events", events), ("_excess", speed * events - total), ("_worst", speed - worst)):
            out = out.append_column(name, pa.array(values[hit]))
        yield from out.combine_chunks().to_batches()


class LimitsBelow:
    """Number, sum and smallest of a group's limits below a speed, at or after a time or up to it."""

    def __init__(self, group: np.ndarray, time: np.ndarray, value: np.ndarray):
        order = np.lexsort((value, time, group))
        self.group, self.time, value = group[order], time[order], value[order]
        self.values, rank = np.unique(value, return_inverse=True)
        self.first = np.searchsorted(self.group, self.group)
        local = np.arange(len(value)) - self.first
        self.levels = []
        width = 1
        while True:  # runs of ``width`` by time within the group, by value within a run; numbered so that searches need one key
            run = self.first + local // width * width
            by_value = np.lexsort((rank, run))
            self.levels.append((width, run[by_value] * (len(self.values) + 1) + rank[by_value],
                                np.append(0.0, np.cumsum(value[by_value])), value[by_value]))
            width *= 2
            if width > local.max(initial=0) + 1:
                break

    def _places(self, group: np.ndarray, time: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per probe the group's start, and how many of its limits lie before ``time`` (``after``: at or before it)."""
        times, stamp = np.unique(np.append(self.time, time), return_inverse=True)
        mine = self.group * (len(times) + 1) + stamp[:len(self.time)]
        wanted = group * (len(times) + 1) + stamp[len(self.time):]
        start = np.searchsorted(self.group, group)
        return start, np.where(after, np.searchsorted(mine, wanted, "right"), np.searchsorted(mine, wanted, "left")) - start

    def _first(self, start: np.ndarray, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the first ``n`` limits from ``start`` on, those with a value rank below ``rank``: whole runs add up to them."""
        count, total, least = np.zeros(len(n), np.int64), np.zeros(len(n)), np.full(len(n), np.inf)
        done = np.zeros(len(n), np.int64)
        for width, code, sums, values in reversed(self.levels):
            at = np.flatnonzero(n - done >= width)
            while len(at):
                run = (start[at] + done[at]) * (len(self.values) + 1)
                low, high = np.searchsorted(code, run), np.searchsorted(code, run + rank[at])
                count[at] += high - low
                total[at] += sums[high] - sums[low]
                some = high > low
                least[at[some]] = np.minimum(least[at[some]], values[low[some]])
                done[at] += width
                at = at[n[at] - done[at] >= width]
        return count, total, least

    def query(self, group: np.ndarray, time: np.ndarray, starting: np.ndarray, speed: np.ndarray):
        if not len(self.group) or not len(group):
            return np.zeros(len(group), np.int64), np.zeros(len(group)), np.full(len(group), np.inf)
        rank = np.searchsorted(self.values, speed, "left")
        start, n = self._places(group, time, ~starting)
        size = np.searchsorted(self.group, group, "right") - start
        # from a time on: the mirror image counts the last limits, so whole blocks less the first ones would lose digits
        count, total, least = self._first(start, np.where(starting, 0, n), rank)
        late = np.flatnonzero(starting)
        if len(late):
            mirror = LimitsBelow(self.group, -self.time, self.levels[0][3])
            count[late], total[late], least[late] = mirror._first(start[late], (size - n)[late], rank[late])
        return count, total, least


def as_limit_side(limits: DataFrame) -> DataFrame:
    """Limits under the names the interval join uses; already renamed frames pass through."""
    if "deviceId_sl" in limits.columns:
        return limits
    return limits.select(F.col("deviceId").alias("deviceId_sl"), "SpeedLimit", F.col("event_time").alias("event_time_speed"))


def overspeed_rows(gps: DataFrame, limits: DataFrame, tolerance: str = "5 minutes",
                   rows_per_slice: int | None = None) -> DataFrame:
    """The joined pairs whose speed is strictly above the limit (unmatched fixes have no limit and drop out)."""
    joined = interval_join(gps, as_limit_side(limits), tolerance, "left", rows_per_slice)
    return joined.where(f"speed > SpeedLimit AND NOT isnan(speed) AND {NUMBER}")


def in_window(rows: DataFrame, width: str) -> DataFrame:
    return rows.withColumn("w", F.window("event_time", width))


def metric_columns(totals: DataFrame, *extra: str) -> DataFrame:
    """The published metric row: device, period label, average, count, maximum."""
    return totals.select(
        "deviceId",
        period_label(F.col("w.start"), F.col("w.end")).alias("period"),
        F.try_divide("total_speed_over_limit", "overspeed_events").alias("avg_speed_over_limit"),
        "overspeed_events",
        "max_speed_over_limit",
        *extra,
    )


def overspeed_metrics(gps: DataFrame, limits: DataFrame, tolerance: str = "5 minutes", window: str = "1 minute",
                      rows_per_slice: int | None = None) -> DataFrame:
    """Per device and tumbling window: average, count and maximum of speed over limit, over (fix, limit) pairs."""
    totals = overspeed_totals(in_window(gps, window), limits, ["deviceId", "w"], tolerance, None, rows_per_slice)
    return metric_columns(totals)


def overspeed_metrics_stream(gps: DataFrame, limits: DataFrame, tolerance: str = "5 minutes",
                             window: str = "1 minute", salts: int = 1) -> DataFrame:
    """The same on two streams: Spark's stream-stream join, then the windowed aggregate (append once closed).

    ``salts`` spreads the join of a very busy device; the aggregate combines before its shuffle anyway.
    """
    over = F.col("speed") - F.col("SpeedLimit")
    fixes = gps.select("deviceId", "speed", "event_time", *[c for c in gps.columns if c == "id"])
    return (
        interval_join(fixes, limits, tolerance, "left", salts=salts)
        .where(f"speed > SpeedLimit AND NOT isnan(speed) AND {NUMBER}")
        .groupBy(F.window("event_time", window).alias("w"), "deviceId")
        .agg(F.sum(over).alias("total_speed_over_limit"), F.count(F.lit(1)).alias("overspeed_events"),
             F.max(over).alias("max_speed_over_limit"))
        .transform(metric_columns)
    )


def overspeed_metrics_asof(gps: DataFrame, limits: DataFrame, window: str = "1 minute", max_age: str | None = None,
                           rows_per_slice: int | None = None) -> DataFrame:
    """Each fix against the one limit in force, the latest at or before it."""
    known = as_of(gps, limits, ["deviceId"], F.col("event_time"), ["SpeedLimit"], ["id"], max_age,
                  rows_per_slice=rows_per_slice)
    over = F.col("speed") - F.col("SpeedLimit")
    totals = (
        in_window(known.where(F.col("speed") > F.col("SpeedLimit")), window)
        .groupBy("deviceId", "w")
        .agg(F.sum(over).alias("total_speed_over_limit"), F.count(F.lit(1)).alias("overspeed_events"),
             F.max(over).alias("max_speed_over_limit"))
    )
    return metric_columns(totals)


def hard_braking(gps: DataFrame, threshold: float = 20.0, max_gap: str = "5 seconds",
                 rows_per_slice: int | None = None) -> DataFrame:
    """Fixes whose speed is at least ``threshold`` below the fix before, if that was at most ``max_gap`` ago."""
    before = F.struct(F.unix_micros("event_time").alias("at"), F.col("speed").alias("speed"))
    line = Timeline(gps, ["deviceId"], F.unix_micros("event_time"), ["id"], rows_per_slice).previous("_before", before)
    rows = line.done().withColumn("_last", F.get("_before", F.lit(0)))
    drop = F.col("_last.speed") - F.col("speed")
    recent = F.unix_micros("event_time") - F.col("_last.at") <= micros(max_gap)
    return (
        rows.withColumn("speed_drop", drop).where((drop >= threshold) & recent)
        .withColumn("speed_before", F.col("_last.speed")).drop("_before", "_last")
    )


def with_trip(gps: DataFrame, gap: str, rows_per_slice: int | None = None) -> DataFrame:
    """Fixes with ``trip_start``: a trip ends where a device is silent for longer than ``gap``."""
    time = F.unix_micros("event_time")
    line = Timeline(gps, ["deviceId"], time, ["id"], rows_per_slice).previous("_before", time)
    last = F.get("_before", F.lit(0))
    starts = F.when(last.isNull() | (time - last > micros(gap)), F.col("event_time"))
    return line.last_known(trip_start=starts).done().drop("_before")


def trip_summary(gps: DataFrame, limits: DataFrame, gap: str = "30 minutes", tolerance: str = "5 minutes",
                 rows_per_slice: int | None = None) -> DataFrame:
    """Per device and trip: fixes, average and top speed, duration, overspeed pairs."""
    # the same filter as in the pair count, so that both uses of the trips are one shuffle
    fixes = with_trip(usable(gps), gap, rows_per_slice)
    by = ["deviceId", "trip_start"]
    trips = fixes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("fixes"), F.avg("speed").alias("avg_speed"), F.max("speed").alias("max_speed"),
        F.max("event_time").alias("trip_end"),
    )
    over = overspeed_totals(fixes, limits, by, tolerance, None, rows_per_slice).select(*by, "overspeed_events")
    return trips.join(over, by, "left").select(
        *by, "trip_end",
        ((F.unix_micros("trip_end") - F.unix_micros("trip_start")) / 1_000_000).alias("duration_s"),
        "fixes", "avg_speed", "max_speed", F.coalesce("overspeed_events", F.lit(0)).alias("overspeed_events"),
    )


def trip_summary_stream(gps: DataFrame, gap: str = "30 minutes", limits: DataFrame | None = None, tolerance: str = "5 minutes",
                        salts: int = 1) -> DataFrame:
    """Trips of a stream, emitted once the watermark passes their silence; with ``limits`` (a speed-limit stream) also their overspeed
    pairs. Fixes and the pairs that the interval join finds go into one session window, which closes when neither can
    bring anything any more."""
    fixes = gps.select("deviceId", "event_time", "speed", F.lit(1).alias("fix"))
    if limits is not None:
        pairs = interval_join(gps.select("deviceId", "event_time", "speed"), limits, tolerance, "inner", salts=salts)
        over = pairs.where(f"speed > SpeedLimit AND NOT isnan(speed) AND {NUMBER}")
        fixes = fixes.unionByName(over.select("deviceId", "event_time", "speed", F.lit(0).alias("fix")))
    seen = F.when(F.col("fix") == 1, F.col("speed"))
    trips = fixes.groupBy("deviceId", F.session_window("event_time", gap).alias("s")).agg(
        F.sum("fix").alias("fixes"), F.sum(seen).alias("total_speed"), F.max(seen).alias("max_speed"),
        F.min("event_time").alias("trip_start"), F.max("event_time").alias("trip_end"), (F.count("*") - F.sum("fix")).alias("overspeed_events"),
    )
    return trips.select(
        "deviceId", "trip_start", "trip_end", ((F.unix_micros("trip_end") - F.unix_micros("trip_start")) / 1_000_000).alias("duration_s"), "fixes",
        (F.col("total_speed") / F.col("fixes")).alias("avg_speed"), "max_speed",
        *([] if limits is None else ["overspeed_events"]),
    )


def with_weather(gps: DataFrame, weather: DataFrame, max_age: str | None = None,
                 rows_per_slice: int | None = None) -> DataFrame:
    """Fixes with the device's latest weather and whether that is risky."""
    rows = as_of(gps, weather, ["deviceId"], F.col("event_time"), ["weatherCondition"], ["id"], max_age,
                 rows_per_slice=rows_per_slice).drop("right_at")
    return rows.withColumn("risky_weather", rules.is_risky_weather(F.col("weatherCondition")))


def _totals_with_weather(gps: DataFrame, weather: DataFrame, limits: DataFrame, tolerance: str, window: str,
                         rows_per_slice: int | None) -> DataFrame:
    fixes = in_window(with_weather(gps, weather, None, rows_per_slice), window)
    totals = overspeed_totals(fixes, limits, ["deviceId", "w"], tolerance, "risky_weather", rows_per_slice)
    return totals.withColumnRenamed("flagged_events", "risky_weather_overspeed")


def metrics_with_weather(gps: DataFrame, weather: DataFrame, limits: DataFrame, tolerance: str = "5 minutes",
                         window: str = "1 minute", rows_per_slice: int | None = None) -> DataFrame:
    """Overspeed metrics plus ``risky_weather_overspeed``: the pairs whose fix was in risky weather."""
    totals = _totals_with_weather(gps, weather, limits, tolerance, window, rows_per_slice)
    return metric_columns(totals, "risky_weather_overspeed")


def ignored_alerts(alerts: DataFrame, gps: DataFrame, horizon: str = "30 seconds",
                   rows_per_slice: int | None = None) -> DataFrame:
    """``slow_down`` alerts whose device's next fix, within ``horizon``, is faster than the target."""
    slow = alerts.where(F.col("action") == "slow_down")
    following = as_of(slow, gps, ["deviceId"], F.col("event_time"), ["speed"], ["id"], horizon, forward=True,
                      rows_per_slice=rows_per_slice)
    return following.where(F.col("speed") > F.col("target_speed"))


def driver_scorecard(gps: DataFrame, limits: DataFrame, weather: DataFrame, alerts: DataFrame,
                     tolerance: str = "5 minutes", window: str = "1 minute", horizon: str = "30 seconds",
                     rows_per_slice: int | None = None) -> DataFrame:
    """Metrics, risky-weather pairs and ignored alerts per device and period, rated and classed."""
    by = ["deviceId", "w"]  # both sides come out of an aggregate on these, so the join needs no further shuffle
    totals = _totals_with_weather(gps, weather, limits, tolerance, window, rows_per_slice)
    missed = in_window(ignored_alerts(alerts, gps, horizon, rows_per_slice), window)
    ignored = missed.groupBy(*by).agg(F.count(F.lit(1)).alias("ignored_alerts"))
    joined = totals.join(ignored, by, "left").withColumn("ignored_alerts", F.coalesce("ignored_alerts", F.lit(0)))
    rows = metric_columns(joined, "risky_weather_overspeed", "ignored_alerts")
    return rate(rows)


def driver_scorecard_stream(fixes: DataFrame, limits: DataFrame, answered: DataFrame, tolerance: str = "5 minutes",
                            window: str = "1 minute", salts: int = 1) -> DataFrame:
    """The same on streams: ``fixes`` with their ``weatherCondition``, ``answered`` alerts with the ``speed`` of the next fix.

    Pairs and ignored alerts meet in one windowed aggregate instead of a join of two; a window without pairs has no metrics.
    """
    over = (F.col("speed") - F.col("SpeedLimit")).alias("over")
    risky = F.coalesce(rules.is_risky_weather(F.col("weatherCondition")), F.lit(False)).cast("int").alias("risky")
    pairs = interval_join(fixes, limits, tolerance, "inner", salts=salts).where(f"speed > SpeedLimit AND NOT isnan(speed) AND {NUMBER}")
    # no filter on the alerts: it would be pushed below their watermark, which heeded ones have to move as well
    missed = F.coalesce((F.col("action") == "slow_down") & (F.col("speed") > F.col("target_speed")), F.lit(False)).cast("int")
    both = pairs.select("deviceId", "event_time", over, risky, F.lit(0).alias("missed")).unionByName(answered.select(
        "deviceId", "event_time", F.lit(None).cast("double").alias("over"), F.lit(0).alias("risky"), missed.alias("missed")))
    totals = both.groupBy(F.window("event_time", window).alias("w"), "deviceId").agg(
        F.sum("over").alias("total_speed_over_limit"), F.count("over").alias("overspeed_events"), F.max("over").alias("max_speed_over_limit"),
        F.sum("risky").alias("risky_weather_overspeed"), F.sum("missed").alias("ignored_alerts"))
    return rate(metric_columns(totals.where("overspeed_events > 0"), "risky_weather_overspeed", "ignored_alerts"))


def rate(metrics: DataFrame) -> DataFrame:
    """Metric rows with ``rating``, ``class`` and feedback; inputs that were not measured count as zero."""
    def column(name: str) -> Column:
        return F.col(name) if name in metrics.columns else F.lit(None).cast("double")

    events, worst = column("overspeed_events"), column("max_speed_over_limit")
    risky, ignored = column("risky_weather_overspeed"), column("ignored_alerts")
    rated = metrics.withColumn("rating", rules.safety_rating(events, worst, risky, ignored))
    return rated.withColumns({
        "class": rules.rating_class(F.col("rating")),
        "strengths": rules.strengths(events, risky, ignored),
        "weaknesses": rules.weaknesses(events, worst, risky, ignored),
        "improvement_tips": rules.improvement_tips(events, worst, risky, ignored),
    })


def evaluations(rated: DataFrame, at: Column) -> DataFrame:
    """Rated metric rows as evaluation messages; ``at`` is the time they are issued."""
    return rated.select(
        F.lit(0).alias("index"), "rating", "class", "strengths", "weaknesses", "improvement_tips", "deviceId", "period",
        F.unix_millis(at).alias("ts"),
    )
