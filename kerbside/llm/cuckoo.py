"""A cuckoo filter over 64-bit keys whose bulk operations are numpy passes."""

from __future__ import annotations

import numpy as np

SLOTS = 4
ROUNDS = 500
#: Share of the slots that a table fills.
FULL = 0.9


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class CuckooFilter:
    """Cuckoo tables of 16-bit prints, the last of which takes insertions until it is full.

    A key may be deleted as often as it was inserted. Lookups never miss a key that is in; a foreign key is
    found with a probability of about 8 / 65535 per table. Each table is larger than the one before:
    keys that share a print and a bucket there share them in all smaller ones, so deleting from the largest down
    never hides another key.
    """

    def __init__(self, capacity: int = 1024) -> None:
        self.tables: list[np.ndarray] = []
        self._grow(capacity)

    def _grow(self, capacity: int) -> None:
        bits = max(4, int(np.ceil(np.log2(max(capacity, 1) / SLOTS / FULL))))
        if self.tables:
            bits = max(bits, int(np.log2(len(self.tables[-1]))) + 1)
        self.tables.append(np.zeros((1 << bits, SLOTS), np.uint16))

    @staticmethod
    def _places(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mixed(keys)
        prints = np.maximum(h >> np.uint64(48), np.uint64(1)).astype(np.uint16)
        first = (h & np.uint64(len(table) - 1)).astype(np.int64)
        return prints, first, CuckooFilter._other(table, first, prints)

    @staticmethod
    def _other(table: np.ndarray, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return bucket ^ (mixed(prints.astype(np.uint64) + np.uint64(77)) & np.uint64(len(table) - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), bool)
        for table in self.tables:
            prints, a, b = self._places(table, keys)
            found |= (table[a] == prints[:, None]).any(1) | (table[b] == prints[:, None]).any(1)
        return found

    def insert(self, keys: np.ndarray) -> None:
        """Insert each key once. A table that can't take them all stays as it was, and a larger one follows."""
        while len(keys):
            table = self.tables[-1]
            if (table != 0).sum() + len(keys) <= FULL * table.size:
                trial = table.copy()
                if self._fill(trial, keys):
                    self.tables[-1] = trial
                    return
            self._grow(2 * len(keys))

    @staticmethod
    def _fill(table: np.ndarray, keys: np.ndarray) -> bool:
        prints, at, _ = CuckooFilter._places(table, keys)
        rng = np.random.default_rng(len(keys))
        for round_ in range(ROUNDS):
            order = np.argsort(at, kind="stable")
            prints, at = prints[order], at[order]
            # in each bucket, as many newcomers as it has free slots take them
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            taken = table[at] != 0
            fits = rank < SLOTS - taken.sum(1)
            free = np.argsort(taken, axis=1, kind="stable")
            table[at[fits], free[fits, rank[fits]]] = prints[fits]
            prints, at = prints[~fits], at[~fits]
            if not len(at):
                return True
            if round_ == 0:  # the others try their second bucket
                at = CuckooFilter._other(table, at, prints)
                continue
            # after that, one newcomer per full bucket throws a print out, which moves to its other bucket
            _, lead = np.unique(at, return_index=True)
            slot = rng.integers(0, SLOTS, len(lead))
            thrown = table[at[lead], slot].copy()
            table[at[lead], slot] = prints[lead]
            prints[lead] = thrown
            at[lead] = CuckooFilter._other(table, at[lead], thrown)
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Take each key out once; only keys that are in may be deleted."""
        for table in reversed(self.tables):
            while len(keys):
                prints, a, b = self._places(table, keys)
                near, far = table[a] == prints[:, None], table[b] == prints[:, None]
                at = np.where(near.any(1), a, b)
                there = near.any(1) | far.any(1)
                place = at * SLOTS + np.where(near.any(1), near.argmax(1), far.argmax(1))
                place[~there] = -1 - np.arange((~there).sum())
                _, lead = np.unique(place, return_index=True)
                lead = lead[there[lead]]
                if not len(lead):
                    break
                table.reshape(-1)[place[lead]] = 0
                rest = np.ones(len(keys), bool)
                rest[lead] = False
                keys = keys[rest]

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.tables), *(len(t) for t in self.tables)], np.int64)
        return sizes.tobytes() + b"".join(t.tobytes() for t in self.tables)

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        got = cls.__new__(cls)
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, 8)
        got.tables, start = [], 8 * (n + 1)
        for size in sizes:
            got.tables.append(np.frombuffer(data, np.uint16, int(size) * SLOTS, start).reshape(-1, SLOTS).copy())
            start += int(size) * SLOTS * 2
        return got
