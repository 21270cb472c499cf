"""As-of join of two streams: both sides wait in keyed state, an event-time timer gives a row out when its match is certain.

A row of the left side can only be matched for good once no more of the right side can come before (or, looking forward,
between) the two, which is when the watermark has passed. So rows wait, one timer stands at the
earliest instant something can be decided, and each firing works off all that the watermark has passed, in time order.
State holds what is later than the watermark, the last right row of a key (looking back), and the right rows that an
undecided left row may still need (looking forward). Rows later than the watermark allows are dropped.

State is kept per share of the keys, not per key, and travels with the rows in Arrow batches: calls to a state store from Python, of which a
key needed a dozen, took most of the time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kerbside.operators.timeline import micros
from kerbside.streaming.stateful import SHARES, Step, _plain, share_of

#: Times inside the packed rows keep their microseconds.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "true"}
COLUMNS = ["device", "t", "side", "tie", "body"]
#: A time after all others, in microseconds.
NEVER = 1 << 60


def nearest_in_time(key: str, reach: int | None, forward: bool, forget: int | None) -> Step:
    """Left rows (side 0) with the last right row (side 1) at or before them, or the first after them within ``reach`` µs."""

    def step(share: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        frames = [] if state.hasTimedOut else [p[COLUMNS] for p in parts]
        if state.exists:
            frames.insert(0, pd.DataFrame({c: pd.Series(v, dtype=kind_of(c)) for c, v in zip(COLUMNS, state.get)}))
        rows = pd.concat(frames, ignore_index=True)
        mark = state.getCurrentWatermarkMs() * 1000
        ties = pd.factorize(rows["tie"], sort=True)[0]  # null comes first
        devices = pd.factorize(rows["device"])[0]
        t, right = rows["t"].to_numpy("int64"), rows["side"].to_numpy("int64") == 1
        order = np.lexsort((ties, ~right, t, devices))  # of rows at one instant those of the right side first
        device, t, right = devices[order], t[order], right[order]
        found, done, keep, wake = (forwards if forward else backwards)(device, t, right, mark)
        if keep.any():
            held = rows.iloc[order[keep]]
            state.update(tuple([_plain(v) for v in held[c].to_numpy(dtype=object)] if c == "tie" else held[c].tolist() for c in COLUMNS))
            state.setTimeoutTimestamp(max(-(-wake // 1000) - 1, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        if done.any():
            # the place of a match, or none, for each row that is done
            near, body = found[done], rows["body"].to_numpy(dtype=object)[order]
            none = near < 0
            yield pd.DataFrame({
                key: rows["device"].to_numpy(dtype=object)[order][done], "t": t[done], "body": body[done],
                "right_t": pd.arrays.IntegerArray(np.where(none, 0, t[near]), none), "found": np.where(none, None, body[near])})

    def backwards(device: np.ndarray, t: np.ndarray, right: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        past = t <= mark
        place = np.arange(len(t))
        last = np.maximum.accumulate(np.where(right & past, place, -1))
        known = (last >= 0) & (device[last] == device)
        near = known if reach is None else known & (t - t[last] <= reach)
        # the last right row of a device stays, unless it is too old and nothing waits
        ends = np.r_[device[1:] != device[:-1], True]
        waits = ~past[ends]  # a device's latest row stands last
        latest = last[ends][known[ends]]
        waits = waits[known[ends]]
        stay = latest if forget is None else latest[waits | (t[latest] + forget > mark)]
        keep = ~past
        keep[stay] = True
        wake = t[~past] if forget is None else np.r_[t[~past], t[stay] + forget]
        wake = wake[wake > mark]
        return np.where(near, last, -1), past & ~right, keep, int(wake.min()) if len(wake) else NEVER

    def forwards(device: np.ndarray, t: np.ndarray, right: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        n = len(t)
        # rights at one instant come before the lefts, so the next right row after a left one is later, and has the smallest tie
        following = np.minimum.accumulate(np.where(right, np.arange(n), n)[::-1])[::-1]
        inside = np.minimum(following, n - 1)
        near = (following < n) & (device[inside] == device) & (t[inside] - t <= reach) & (t[inside] <= mark)
        done = ~right & (near | (t + reach <= mark))
        open_ = ~right & ~done
        first = np.full(device.max() + 1, NEVER)
        np.minimum.at(first, device[open_], t[open_])
        keep = open_ | right & ((t > mark) | (t > first[device]))
        wake = np.r_[t[open_] + reach, t[right & (t > mark)]]
        return np.where(near, following, -1), done, keep, int(wake.min()) if len(wake) else NEVER

    return step


def kind_of(column: str) -> str:
    return "int64" if column in ("t", "side") else "object"


def as_of_stream(left: DataFrame, right: DataFrame, payload: Sequence[str], key: str = "deviceId", tie: str = "id",
                 max_age: str | None = None, forward: bool = False, late: str = "1 minute", forget: str | None = None,
                 shares: int = SHARES) -> DataFrame:
    """Stream twin of ``as_of``: ``left`` with ``right_at`` and ``payload`` of its match, once that is certain.

    Neither side may carry a watermark yet; rows may be ``late`` by so much. Looking forward needs ``max_age``. With ``forget``
    a key silent for so long loses its last right row. A call takes the keys of one of ``shares`` shares. The rows are given out after
    their time, so what aggregates them by time is a query of its own, which reads what this one wrote.
    """
    if forward and not max_age:
        raise ValueError("looking forward needs max_age")
    brought = {c.lower() for c in ("right_at", *payload)}
    left = left.drop(*[c for c in left.columns if c.lower() in brought])
    kind = "string" if tie not in right.columns else right.schema[tie].dataType.simpleString()

    def packed(frame: DataFrame, side: int, columns: Sequence[str]) -> DataFrame:
        place = F.col(tie) if tie in frame.columns else F.lit(None)
        return frame.where(F.col("event_time").isNotNull() & F.col(key).isNotNull()).select(
            key, "event_time", F.lit(side).alias("side"), place.cast(kind).alias("tie"), F.to_json(F.struct(*columns), JSON).alias("body"))

    both = packed(left, 0, left.columns).unionByName(packed(right, 1, payload)).withWatermark("event_time", late)
    # the event time goes along because late rows are dropped by it
    sent = both.select(share_of(key, shares), "event_time", F.col(key).alias("device"), F.unix_micros("event_time").alias("t"), "side", "tie", "body")
    device = left.schema[key].dataType.simpleString()
    found = sent.groupBy("share").applyInPandasWithState(
        nearest_in_time(key, micros(max_age) if max_age else None, forward, micros(forget) if forget else None),
        f"{key} {device}, t long, body string, right_t long, found string",
        f"device array<{device}>, t array<bigint>, side array<int>, tie array<{kind}>, body array<string>", "append", GroupStateTimeout.EventTimeTimeout)
    unpacked = found.select(
        F.from_json("body", left.schema, JSON).alias("l"), F.timestamp_micros("right_t").alias("right_at"),
        F.from_json("found", right.select(*payload).schema, JSON).alias("r"))
    return unpacked.select("l.*", "right_at", *[F.col(f"r.{c}").alias(c) for c in payload])
