"""Hash-compared suffix sort: prefix polynomial hashes, extensions by binary search, mergesort, verification.

Substring hashes are polynomials modulo 2**64 over random 64-bit values of the bytes. Equal hashes only suggest equal
bytes: every common extension that a result rests on is compared byte by byte afterwards, with the byte after it, and a
sort that a collision has misled is done again on the bytes themselves.
"""

from __future__ import annotations

from functools import cache

import numpy as np

from kerbside.llm.cuckoo import mixed

BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
REFINEMENTS = 3
#: Bytes whose hashes are summed up at a time.
STRETCH = 1 << 20
#: Powers kept for all texts of a task; a longer text has its own.
FIRST = 1 << 17
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def powers(base: np.uint64, n: int) -> np.ndarray:
    if n < FIRST:
        return first_powers(base)[:n]
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


@cache
def first_powers(base: np.uint64) -> np.ndarray:
    return powers(base, FIRST)


class Hashes:
    """Hash of any substring of ``data`` from one pass over it.

    ``exponent`` numbers the bytes; by default from 0 on. Texts that lie one after the other may each start at 0, if
    no substring crosses them: what is kept per byte is then its running sum and its number.
    """

    def __init__(self, data: np.ndarray, exponent: np.ndarray | None = None) -> None:
        self.data, self.exponent = data, exponent
        highest = max(len(data), 1) if exponent is None else int(exponent.max(initial=0)) + 1
        power, self.back = powers(BASE, highest), powers(UNBASE, highest)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        for at in range(0, len(data), STRETCH):
            part = slice(at, at + STRETCH)
            values = BYTE_VALUES[data[part]] * (power[part] if exponent is None else power[exponent[part]])
            values[:1] += self.prefix[at:at + 1]
            np.cumsum(values, out=self.prefix[at + 1:at + 1 + len(values)])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        first = np.minimum(start, max(len(self.data) - 1, 0))
        if self.exponent is not None and len(self.data):
            first = self.exponent[first]
        return (self.prefix[start + length] - self.prefix[start]) * self.back[first]

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all substrings of ``width`` bytes, where the bytes are numbered from 0 on."""
        sums = self.prefix[width:] - self.prefix[:-width]
        return sums * self.back[:len(sums)]


class Suffixes:
    """Contexts around places of ``data``: ``right[i]`` bytes from place i on and ``left[i]`` before it."""

    def __init__(self, data: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray,
                 known: int = 0) -> None:
        """Groups ascend; the first ``known`` bytes to the right are the same in a group."""
        begin, size = place - left, left + right
        apart = len(place) > 0 and (begin[1:] == (begin + size)[:-1]).all() and begin[0] == 0 and size.sum() == len(data)
        number = (np.arange(len(data), dtype=np.int32) - np.repeat(begin.astype(np.int32), size)) if apart else None
        self.hashes, self.data = Hashes(data, number), data
        self.place, self.left, self.right, self.group, self.known = place, left, right, group, known

    def extension(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """Common bytes of contexts i and j, found by binary search over hashes."""
        limit = np.minimum(self.right[i], self.right[j]) if forward else np.minimum(self.left[i], self.left[j])
        low, high = np.zeros_like(limit), limit.copy()
        for _ in range(int(limit.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            a, b = (self.place[i], self.place[j]) if forward else (self.place[i] - middle, self.place[j] - middle)
            same = self.hashes.of(a, middle) == self.hashes.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """Whether context i sorts before context j; equal ones don't."""
        n = self.extension(i, j, forward)
        size = self.right if forward else self.left
        ended_i, ended_j = n >= size[i], n >= size[j]
        step = n if forward else -1 - n
        last = len(self.data) - 1
        a, b = self.data[np.clip(self.place[i] + step, 0, last)], self.data[np.clip(self.place[j] + step, 0, last)]
        return np.where(ended_j, False, np.where(ended_i, True, a < b))

    def bytes_after(self, which: np.ndarray, skipped: np.ndarray, forward: bool) -> np.ndarray:
        """Eight bytes of each context's side after the skipped ones as one number; zeros follow its end."""
        size = (self.right if forward else self.left)[which] - skipped
        step = np.arange(8)
        at = (self.place[which] + skipped)[:, None] + step if forward else (self.place[which] - 1 - skipped)[:, None] - step
        found = self.data[np.clip(at, 0, len(self.data) - 1)]
        return np.where(step < size[:, None], found, 0).astype(np.uint8).view(">u8").reshape(-1).astype(np.uint64)

    def sorted(self, forward: bool) -> np.ndarray:
        """Contexts in order within each group.

        Sides with equal hashes are sorted once. The bytes after what a group has in common split it, a few times
        over; those still together are put in order by a mergesort whose runs all merge at once.
        """
        size = self.right if forward else self.left
        whole = mixed(self.hashes.of(self.place if forward else self.place - size, size) ^ size.astype(np.uint64))
        by_side = np.lexsort((whole, self.group))
        differs = (whole[by_side][1:] != whole[by_side][:-1]) | (self.group[by_side][1:] != self.group[by_side][:-1])
        side = np.r_[0, np.cumsum(differs)] if len(by_side) else by_side
        one = by_side[np.r_[True, differs]] if len(by_side) else by_side
        group, skipped = self.group[one], np.full(len(one), self.known if forward else 0)
        for _ in range(REFINEMENTS):  # by the bytes after what all of a group have in common
            following = self.bytes_after(one, skipped, forward)
            place = np.lexsort((following, group))
            one, following, old = one[place], following[place], group[place]
            changes = np.r_[True, (following[1:] != following[:-1]) | (old[1:] != old[:-1])] if len(one) else following
            starts = np.flatnonzero(changes)
            group = np.cumsum(changes).astype(np.int64)
            if len(starts) == len(one):
                break
            common = self.extension(one, np.repeat(one[starts], np.diff(np.r_[starts, len(one)])), forward)
            skipped = np.repeat(np.minimum.reduceat(common, starts), np.diff(np.r_[starts, len(one)]))
        one = self._merged(one, group, forward)
        rank = np.empty(len(one), np.int64)
        number = np.empty(len(self.group), np.int64)
        number[by_side] = side
        rank[number[one]] = np.arange(len(one))
        return np.argsort(rank[number], kind="stable") if len(one) else one

    def _merged(self, order: np.ndarray, group: np.ndarray, forward: bool) -> np.ndarray:
        """``order`` with the contexts of each (ascending) group sorted."""
        order = order.copy()
        first = np.searchsorted(group, group)
        size = np.searchsorted(group, group, side="right") - first
        local = np.arange(len(order)) - first
        width = 1
        while width < size.max(initial=0):
            at = np.flatnonzero(size > width)
            run = local[at] // width
            base = (run // 2) * 2 * width
            odd = run % 2 == 1
            other = base + np.where(odd, 0, width)
            low = first[at] + np.minimum(other, size[at])
            start = low.copy()
            high = first[at] + np.minimum(other + width, size[at])
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                mine, theirs = order[at[open_]], order[middle]
                # elements of the second run come after equal ones of the first
                ahead = np.where(odd[open_], ~self.before(mine, theirs, forward), self.before(theirs, mine, forward))
                low[open_] = np.where(ahead, middle + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], middle)
            target = first[at] + base + (local[at] - run * width) + (low - start)
            merged = order.copy()
            merged[target] = order[at]
            order = merged
            width *= 2
        return order

    def neighbours(self, order: np.ndarray, forward: bool) -> tuple[np.ndarray, bool]:
        """Common extension of each context in order with the next one (0 at a group's end).

        True if the bytes agree so far and the first that differ ascend.
        """
        common = np.zeros(len(order), np.int64)
        inner = np.flatnonzero(self.group[order[1:]] == self.group[order[:-1]])
        held = True
        for part in np.array_split(inner, max(1, len(inner) // 20_000)):
            i, j = order[part], order[part + 1]
            n = self.extension(i, j, forward)
            step = np.arange(int(n.max(initial=0)))
            move = step if forward else -1 - step
            last = len(self.data) - 1
            same = (self.data[np.clip(self.place[i][:, None] + move, 0, last)]
                    == self.data[np.clip(self.place[j][:, None] + move, 0, last)])
            held = held and bool((same | (step >= n[:, None])).all()) and self._ascends(i, j, n, forward)
            common[part] = n
        return common, held

    def _ascends(self, i: np.ndarray, j: np.ndarray, n: np.ndarray, forward: bool) -> bool:
        """Whether after ``n`` common bytes each context i ends or goes on with a smaller byte than j."""
        size, last = self.right if forward else self.left, len(self.data) - 1
        step = n if forward else -1 - n
        a, b = self.data[np.clip(self.place[i] + step, 0, last)], self.data[np.clip(self.place[j] + step, 0, last)]
        return bool(((n >= size[i]) | ((n < size[j]) & (a < b))).all())

    def by_bytes(self, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Order and common extensions without hashes."""
        def own(i: int) -> bytes:
            p = self.place[i]
            return self.data[p:p + self.right[i]].tobytes() if forward else self.data[p - self.left[i]:p][::-1].tobytes()

        order = np.array(sorted(range(len(self.group)), key=lambda i: (self.group[i], own(i))), np.int64)
        common = np.zeros(len(order), np.int64)
        for t in range(len(order) - 1):
            if self.group[order[t]] == self.group[order[t + 1]]:
                a, b = own(order[t]), own(order[t + 1])
                common[t] = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return order, common

    def order_and_common(self, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        order = self.sorted(forward)
        common, held = self.neighbours(order, forward)
        return (order, common) if held else self.by_bytes(forward)

    def shared(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest d for which context i's ``length`` bytes from d before its place on are
        those of another context of its group; -1 where there is none.

        Contexts that agree on the right for length - d bytes are neighbours in one order, those that agree on
        the left for d bytes in the other; two share the string if both blocks are the same.
        """
        n = len(self.group)
        smallest, largest = np.full(n, -1), np.full(n, -1)
        right, right_common = self.order_and_common(True)
        left, left_common = self.order_and_common(False)
        for d in range(int(self.left.max(initial=0)) + 1):
            fits = np.flatnonzero((self.left >= d) & (self.right >= length - d))
            if len(fits) < 2:
                continue
            block_right, block_left = np.empty(n, np.int64), np.empty(n, np.int64)
            block_right[right] = np.r_[0, np.cumsum(right_common[:-1] < length - d)]
            ends = (left_common[:-1] < d) | (self.group[left[1:]] != self.group[left[:-1]])
            block_left[left] = np.r_[0, np.cumsum(ends)]
            code = block_right[fits] * n + block_left[fits]
            order = np.argsort(code, kind="stable")
            equal = code[order[1:]] == code[order[:-1]]
            hit = fits[order[np.r_[equal, False] | np.r_[False, equal]]]
            largest[hit] = d
            smallest[hit] = np.where(smallest[hit] < 0, d, smallest[hit])
        return smallest, largest
