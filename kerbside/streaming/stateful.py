"""Keyed stateful operators of a stream. Each has a batch twin with the same columns.

A key's rows of one micro-batch are put in (time, id) order before they meet the state; rows that arrive a whole
micro-batch late are taken in arrival order. What one call holds is one key's share of one micro-batch, so the source's
rate limit (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bounds it also for a very busy device. State travels with
the rows in Arrow batches, many keys to a batch, so a key costs no round trip of its own.

``state_stream``, and ``asof``, where every device comes in every batch, take the devices of one of ``SHARES`` shares in one call: the call
costs the same for one device as for a hundred, and columns of a share are worked on as arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kerbside.operators.cache import TIME_TO_LIVE
from kerbside.operators.timeline import micros
from kerbside.operators.windows import LOOK_BACK, SIMILAR_WITHIN, emit_flags

#: Shares that devices are dealt over; a share should have no more rows in a micro-batch than a call can hold. Choose before
#: the first checkpoint.
SHARES = 2048

Step = Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]


def share_of(key: str, shares: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shares)).cast("int").alias("share")


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    parts = list(rows)
    batch = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    return batch.iloc[np.lexsort((batch["id"].to_numpy(), batch["at_us"].to_numpy()))]


def forgetful(step: Step, forget: str | None) -> tuple[Step, str]:
    """``step`` that drops the state of a key once the watermark, which its rows must carry, is ``forget`` past the key's
    newest row; and the timeout to run it with. Without ``forget`` state stays, as in the batch twins."""
    if not forget:
        return step, GroupStateTimeout.NoTimeout
    wait = micros(forget) // 1000

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = list(parts)
        newest = max(int(p["at_us"].max()) for p in held) // 1000
        yield from step(key, iter(held), state)
        state.setTimeoutTimestamp(max(newest + wait, state.getCurrentWatermarkMs() + 1))

    return run, GroupStateTimeout.EventTimeTimeout


def _keyed(rows: DataFrame, key: str, step: Step, columns: list[str], added: str, state: str,
           timeout: str = GroupStateTimeout.NoTimeout, forget: str | None = None) -> DataFrame:
    if forget:
        step, timeout = forgetful(step, forget)
    sent = rows.select(*columns, F.unix_micros("event_time").alias("at_us"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema.fields if f.name != "at_us")
    return sent.groupBy(key).applyInPandasWithState(step, f"{kinds}, {added}", state, "append", timeout)


def throttle_stream(rows: DataFrame, gap: str = "2 seconds", forget: str | None = None) -> DataFrame:
    """Stream twin of ``throttle``: needs ``id``, ``deviceId``, ``event_time``."""
    gap_us = micros(gap)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch = _in_order(parts)
        flags, last = emit_flags(batch["at_us"].to_numpy(), gap_us, state.get[0] if state.exists else None)
        state.update((last,))
        yield batch.drop(columns="at_us").assign(emitted=flags)

    return _keyed(rows, "deviceId", step, ["id", "deviceId", "event_time"], "emitted boolean", "last_emission long", forget=forget)


def state_stream(messages: DataFrame, fields: dict[str, str], gap: str | None = None, forget: str | None = None,
                 shares: int = SHARES) -> DataFrame:
    """Stream twin of ``device_state``: each message with the device's state after it (``fields``: name -> SQL type).

    With ``gap`` only messages that pass the throttle come out; the others still update the state. Messages need ``id``,
    ``topic``, ``deviceId``, ``event_time``; several at one instant are taken by id, then topic. A call takes the devices of one share;
    of a share the state holds, side by side, the devices, the time of their newest message, their last emission and their fields.
    """
    gap_us = micros(gap) if gap else None
    wait = micros(forget) // 1000 if forget else None
    names = list(fields)
    held_columns = ["device", "newest", "last_emission", *names]

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = dict(zip(held_columns, state.get)) if state.exists else {c: [] for c in held_columns}
        batch = pd.concat(list(parts), ignore_index=True) if not state.hasTimedOut else None
        seen = [] if batch is None else pd.unique(batch["deviceId"])
        mark = state.getCurrentWatermarkMs() if wait is not None else None
        place = {device: i for i, device in enumerate(held["device"])}
        known = {d: [held[c][place[d]] for c in held_columns[1:]] for d in seen if d in place}
        # of the devices without a message here those stay that are not silent for too long
        silent = set(held["device"]).difference(seen)
        stay = [i for d, i in place.items() if d in silent and (wait is None or held["newest"][i] + wait >= mark)]
        left = {c: [held[c][i] for i in stay] for c in held_columns}
        if batch is not None:
            batch = batch.sort_values(["deviceId", "at_us", "id", "topic"])
            devices, at_us = batch["deviceId"].to_numpy(), batch["at_us"].to_numpy()
            first = np.flatnonzero(np.r_[True, devices[1:] != devices[:-1]])
            last = np.r_[first[1:], len(batch)] - 1
            before = [known.get(d) for d in devices[first]]
            # one place before each device's messages for what was known of it
            row = np.arange(len(batch)) + np.repeat(np.arange(1, len(first) + 1), last - first + 1)
            start = first + np.arange(len(first))
            merged = {}
            for n, name in enumerate(names):
                line = np.empty(len(batch) + len(first), dtype=object)
                line[start] = [b and b[2 + n] for b in before]
                line[row] = batch[name].to_numpy(dtype=object)
                at = np.where(pd.notna(line), np.arange(len(line)), 0)
                at[start] = start
                merged[name] = line[np.maximum.accumulate(at)[row]]
                left[name] += [_plain(v) for v in merged[name][last]]
            flags, emissions = np.ones(len(batch), dtype=bool), [b and b[1] for b in before]
            if gap_us is not None:
                for n, (lo, hi) in enumerate(zip(first, last + 1)):
                    flags[lo:hi], emissions[n] = emit_flags(at_us[lo:hi], gap_us, emissions[n])
            left["device"] += devices[first].tolist()
            left["newest"] += (at_us[last] // 1000).tolist()
            left["last_emission"] += emissions
            out = batch[["id", "topic", "deviceId", "event_time"]].assign(**merged)[flags]
            if len(out):
                yield out
        if not left["device"]:
            state.remove()
            return
        state.update(tuple(left[c] for c in held_columns))
        if wait is not None:
            state.setTimeoutTimestamp(max(min(left["newest"]) + wait, state.getCurrentWatermarkMs() + 1))

    columns = ["id", "topic", "deviceId", "event_time"]
    kinds = ", ".join(f"`{n}` {k}" for n, k in fields.items())
    sent = messages.select(share_of("deviceId", shares), *columns, *names, F.unix_micros("event_time").alias("at_us"))
    ids, devices = (sent.schema[c].dataType.simpleString() for c in ("id", "deviceId"))
    out = f"id {ids}, topic string, deviceId {devices}, event_time timestamp, {kinds}"
    arrays = ", ".join(f"`{n}` array<{k}>" for n, k in fields.items())
    timeout = GroupStateTimeout.EventTimeTimeout if forget else GroupStateTimeout.NoTimeout
    return sent.groupBy("share").applyInPandasWithState(
        step, out, f"device array<{devices}>, newest array<bigint>, last_emission array<bigint>, {arrays}", "append", timeout)


def _plain(value):
    """A state value as Python has it: no NumPy scalars, no NaN."""
    if value is None or value != value:
        return None
    return value.item() if isinstance(value, np.generic) else value


def alert_dedupe_stream(alerts: DataFrame, within: float = SIMILAR_WITHIN, look_back: int = LOOK_BACK,
                        forget: str | None = None) -> DataFrame:
    """Stream twin of ``alert_dedupe``; alerts need an ``id``, further columns come out as they went in."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch = _in_order(parts)
        known_actions, known_targets = state.get if state.exists else ([], [])
        actions = np.array([*known_actions, *batch["action"]], dtype=object)
        targets = np.array([*known_targets, *batch["target_speed"]], dtype="float64")
        similar = np.zeros(len(actions), dtype=bool)
        for back in range(1, min(look_back, len(actions) - 1) + 1):
            same = (actions[back:] == actions[:-back]) & pd.notna(actions[back:])  # no action is like no other
            similar[back:] |= same & (np.abs(targets[back:] - targets[:-back]) < within)
        state.update((actions[-look_back:].tolist(), targets[-look_back:].tolist()))
        yield batch.drop(columns="at_us").assign(suppressed=similar[len(known_actions):])

    columns = ["id", "deviceId", "event_time", "action", "target_speed", *[c for c in ("reason",) if c in alerts.columns]]
    return _keyed(alerts, "deviceId", step, columns, "suppressed boolean", "actions array<string>, targets array<double>",
                  forget=forget)


def count_windows_stream(gps: DataFrame, size: int = 3, forget: str | None = None) -> DataFrame:
    """Stream twin of ``count_windows`` per device; fixes need a whole-number ``id``. A window that is not full yet waits
    in the state, across restarts too, until the device is forgotten."""

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch = _in_order(parts)
        number, open_ids, open_places, open_times = state.get if state.exists else (0, [], [], [])
        ids = [*open_ids, *map(int, batch["id"])]
        places = [*map(list, open_places), *([float(p[0]), float(p[1])] for p in batch["location"])]
        times = [*open_times, *map(int, batch["at_us"])]
        full = len(ids) // size
        ends = range(size, full * size + 1, size)
        rest = full * size
        state.update((number + full, ids[rest:], places[rest:], times[rest:]))
        if full:
            yield pd.DataFrame({
                "id": [ids[e - 1] for e in ends], "deviceId": key[0],
                "event_time": pd.to_datetime([times[e - 1] for e in ends], unit="us", utc=True),
                "location": [places[e - 1] for e in ends],
                "window_no": range(number, number + full),
                "fix_ids": [ids[e - size:e] for e in ends],
                "path": [places[e - size:e] for e in ends],
            })

    columns = ["id", "deviceId", "event_time", "location"]
    added = "window_no long, fix_ids array<bigint>, path array<array<double>>"
    held = "next_window long, ids array<bigint>, places array<array<double>>, times array<bigint>"
    return _keyed(gps, "deviceId", step, columns, added, held, forget=forget)


def cache_write_stream(writes: DataFrame, ttl: str = TIME_TO_LIVE) -> DataFrame:
    """Cache entries as they change: at most one row per key and micro-batch, never an older over a newer one.

    The time to live runs in event time: when the watermark (which ``writes`` must carry) passes an entry's end, the entry
    leaves the state. A replay therefore gives the same entries as the live run.
    """
    ttl_us = micros(ttl)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        newest = _in_order(parts).iloc[[-1]]
        at = (int(newest["at_us"].iloc[0]), int(newest["id"].iloc[0]))
        held = tuple(state.get) if state.exists else None
        kept = held if held is not None and held >= at else at
        state.update(kept)
        end = kept[0] + ttl_us
        # a call without this would lose the timeout set before
        state.setTimeoutTimestamp(max(end // 1000, state.getCurrentWatermarkMs() + 1))
        if kept is not held:
            yield newest.drop(columns="at_us").assign(expires_at=pd.to_datetime([end], unit="us", utc=True))

    columns = ["key", "value", "event_time", "id"]
    return _keyed(writes, "key", step, columns, "expires_at timestamp", "at long, id long", GroupStateTimeout.EventTimeTimeout)
