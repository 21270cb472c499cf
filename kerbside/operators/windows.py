"""Per-device sequences: look-back duplicates, newest alerts, count windows, throttle, batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.operators.timeline import Timeline, micros, numbered

LOOK_BACK = 4
SIMILAR_WITHIN = 2.0
KEPT_ALERTS = 5


def message_order(rows: DataFrame) -> list[str]:
    """What orders messages of one instant: their id, or all they say where they carry none."""
    if "id" in rows.columns:
        return ["id"]
    return [c for c in rows.columns if c not in ("deviceId", "event_time")]


def alert_dedupe(alerts: DataFrame, within: float = SIMILAR_WITHIN, look_back: int = LOOK_BACK,
                 rows_per_slice: int | None = None) -> DataFrame:
    """Alerts with ``suppressed``: one of the device's ``look_back`` alerts before has the same action and a target
    speed less than ``within`` away. Suppressed alerts stay in the look-back."""
    line = Timeline(alerts, ["deviceId"], F.unix_micros("event_time"), message_order(alerts), rows_per_slice)
    rows = line.previous("_before", F.struct("action", "target_speed"), look_back).done()
    similar = F.exists(
        "_before",
        lambda p: (p["action"] == F.col("action")) & (F.abs(p["target_speed"] - F.col("target_speed")) < within),
    )
    return rows.withColumn("suppressed", F.coalesce(similar, F.lit(False))).drop("_before")


def recent_alerts(alerts: DataFrame, kept: int = KEPT_ALERTS) -> DataFrame:
    """The newest ``kept`` alerts per device. Spark keeps ``kept`` rows per device and task before the shuffle."""
    newest = Window.partitionBy("deviceId").orderBy(F.desc("event_time"), *[F.desc(c) for c in message_order(alerts)])
    return alerts.withColumn("recency", F.row_number().over(newest)).where(F.col("recency") <= kept)


def count_windows(gps: DataFrame, size: int = 3, per_device: bool = True,
                  rows_per_slice: int | None = None) -> DataFrame:
    """Every ``size`` fixes -> one row: their places in order, and device, time and place of the last fix.

    Windows fill per device, or over all devices in time order (``per_device=False``), which numbers the rows over
    ranges of that order. A window that does not fill up gives no row.
    """
    keys = ["deviceId"] if per_device else []
    if per_device:
        counted = Timeline(gps, keys, F.unix_micros("event_time"), ["id"], rows_per_slice).row_number("_n").done()
    else:
        counted = numbered(gps, "_n", [F.unix_micros("event_time"), F.col("id")])
    windowed = counted.withColumn("window_no", F.floor((F.col("_n") - 1) / size))
    fix = F.struct("_n", "location", "id", "deviceId", "event_time")
    by = [*keys, "window_no"]
    full = windowed.groupBy(*by).agg(F.sort_array(F.collect_list(fix)).alias("_fixes"))
    last = F.get("_fixes", F.lit(size - 1))
    return full.where(F.size("_fixes") == size).select(
        "window_no", last["deviceId"].alias("deviceId"), last["event_time"].alias("event_time"), last["id"].alias("id"),
        last["location"].alias("location"),
        F.transform("_fixes", lambda x: x["location"]).alias("path"),
        F.transform("_fixes", lambda x: x["id"]).alias("fix_ids"),
    )


# --- throttle -----------------------------------------------------------------------------------------------------


def emit_flags(times: np.ndarray, gap: int, last: int | None) -> tuple[np.ndarray, int | None]:
    """Which of the sorted ``times`` are emitted, each at least ``gap`` after the emission before; and the last one.

    Jumps from emission to emission with a binary search, so rows in between cost nothing.
    """
    flags = np.zeros(len(times), dtype=bool)
    at = 0 if last is None else int(np.searchsorted(times, last + gap, "left"))
    while at < len(times):
        flags[at] = True
        last = int(times[at])
        at = int(np.searchsorted(times, last + gap, "left"))
    return flags, last


def exit_table(times: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """What a slice does to the last emission, without knowing it.

    The first emission in the slice is its first row at or after ``previous + gap``, so it depends on the previous
    emission only among rows up to ``gap`` after the slice's first row. For each such entry row the chain of emissions is
    followed to its end by pointer doubling. Returns entry times and the last emission each leads to; neighbours with the
    same result are merged, keeping the latest entry time.
    """
    n = len(times)
    following = np.searchsorted(times, times + gap, "left")
    end = np.arange(n + 1)
    end[:n] = np.where(following < n, following, np.arange(n))
    while True:
        further = end[end]
        if np.array_equal(further, end):
            break
        end = further
    entries = min(n, int(np.searchsorted(times, times[0] + gap, "left")) + 1)
    last = times[end[:entries]]
    keep = np.append(last[1:] != last[:-1], True)
    return times[:entries][keep], last[keep]


def _flag_sorted_groups(batches: Iterator[pa.RecordBatch], group: Sequence[str], gap: int) -> Iterator[pa.RecordBatch]:
    """Flag rows that arrive sorted by group and time; the last emission of the open group crosses batch borders."""
    open_group, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(g).to_numpy(zero_copy_only=False) for g in group]
        times = batch.column("_at").to_numpy(zero_copy_only=False)
        entry = batch.column("_entry")
        changes = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            changes[1:] |= key[1:] != key[:-1]
        changes[0] = True
        starts = np.flatnonzero(changes)
        flags = np.zeros(batch.num_rows, dtype=bool)
        for start, stop in zip(starts, np.append(starts[1:], batch.num_rows)):
            this_group = tuple(key[start] for key in keys)
            if this_group != open_group:
                open_group, last = this_group, entry[int(start)].as_py()
            flags[start:stop], last = emit_flags(times[start:stop], gap, last)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flags)], names=[*batch.schema.names, "emitted"])


def throttle(rows: DataFrame, gap: str = "2 seconds", rows_per_slice: int | None = None) -> DataFrame:
    """Rows with ``emitted``: the first of a device, then each row at least ``gap`` after the last emitted one.

    Whether a row is emitted depends on all rows before it, so no window function can say it. Rows are partitioned by
    (device, slice) and sorted, and Arrow batches stream through each task with one number of state. For a device that
    was cut into slices, every slice first reports its ``exit_table``; following these tables from slice to slice gives
    each slice its entry state, and the slices then run in parallel.
    """
    gap_us = micros(gap)
    line = Timeline(rows, ["deviceId"], F.unix_micros("event_time"), ["id"], rows_per_slice)
    frame, group = line.rows, line.group
    if line.sliced:
        tables = frame.where("_hot").select(*group, "_at").groupBy(*group).applyInPandas(
            lambda key, pdf: _exit_rows(key, pdf, gap_us), "deviceId string, _slice int, entry long, last long"
        )  # a hot key is never null, so it has one spread
        entries = tables.groupBy("deviceId").applyInPandas(
            lambda pdf: _follow(pdf, gap_us), "deviceId string, _slice int, _entry long"
        )
        frame = frame.join(F.broadcast(entries), ["deviceId", "_slice"], "left")  # one row per slice of a hot device
    else:
        frame = frame.withColumn("_entry", F.lit(None).cast("bigint"))
    columns = [f for f in frame.schema.fields if f.name not in ("_at", "_slice", "_hot", "_spread", "_entry")]
    ordered = frame.repartition(*group).sortWithinPartitions(*group, "_at", "id")
    sent = ordered.select(*[f.name for f in columns], "_at", "_entry", *[g for g in group if g in ("_spread", "_slice")])
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema.fields)
    flagged = sent.mapInArrow(lambda it: _flag_sorted_groups(it, group, gap_us), out + ", emitted boolean")
    return flagged.select(*[f.name for f in columns], "emitted")


def _exit_rows(key: tuple, pdf: pd.DataFrame, gap: int) -> pd.DataFrame:
    entry, last = exit_table(np.sort(pdf["_at"].to_numpy()), gap)
    return pd.DataFrame({"deviceId": key[0], "_slice": int(key[-1]), "entry": entry, "last": last})


def _follow(pdf: pd.DataFrame, gap: int) -> pd.DataFrame:
    """Entry state of every slice of one device (at most a few numbers per slice come in)."""
    pdf = pdf.sort_values(["_slice", "entry"])
    slices, states, last = [], [], None
    for number, table in pdf.groupby("_slice", sort=True):
        slices.append(number)
        states.append(last)
        entry = table["entry"].to_numpy()
        at = 0 if last is None else int(np.searchsorted(entry, last + gap, "left"))
        if at < len(entry):
            last = int(table["last"].iloc[at])
    return pd.DataFrame({
        "deviceId": pdf["deviceId"].iloc[0], "_slice": pd.array(slices, dtype="int32"),
        "_entry": pd.array(states, dtype="Int64"),
    })


# --- batches ------------------------------------------------------------------------------------------------------


def metrics_batches(metrics: DataFrame, arrival: Column, ties: Sequence[str], size: int = 1) -> DataFrame:
    """Rows in order of ``arrival`` (a BIGINT) cut into batches of ``size``: adds ``batch_id`` and ``index``."""
    place = F.col("_n") - 1
    return numbered(metrics, "_n", [arrival, *[F.col(c) for c in ties]]).withColumns({
        "batch_id": F.floor(place / size), "index": (place % size).cast("int"),
    }).drop("_n")


def full_batches(batched: DataFrame, size: int = 1, metric: Sequence[str] = ()) -> DataFrame:
    """One row per full batch with its metrics in index order; a batch is sent only once it is full."""
    item = F.struct("index", *metric)
    lists = batched.groupBy("batch_id").agg(F.sort_array(F.collect_list(item)).alias("batch"))
    return lists.where(F.size("batch") == size)


def first_batches(batches: DataFrame, calls: int = 5) -> DataFrame:
    """The batches the call quota allows."""
    return batches.orderBy("batch_id").limit(calls)
