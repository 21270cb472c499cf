"""Suffix dedup against every string of the fixture."""

from collections import Counter

import numpy as np
import pytest

from kerbside.llm import suffix_dedup
from kerbside.llm.suffix_sort import Suffixes

SCHEMA = "doc_id long, text string, gram string, bytes string"
L, GRAM = 40, 12


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    times = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if times[d[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0]))
        spans = [(int(a), int(b)) for a, b in zip(edge[::2], edge[1::2])]
        out.append((len(d), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def texts():
    rng = np.random.default_rng(11)
    letters = "abcdé "
    random = lambda n: "".join(letters[i] for i in rng.integers(0, len(letters), n))
    passages = [random(n) for n in (41, 39, 60, 200, 45)]
    out = [None, "", "short", "a" * 500, "ab" * 300, "a" * 39, random(3000)]
    for i in range(120):
        out.append(random(int(rng.integers(0, 60))) + passages[i % 5][int(rng.integers(0, 6)):] + random(int(rng.integers(0, 90)))
                   + (passages[(i + 1) % 5] if i % 3 else ""))
    out += [out[10], out[10], out[11] + "x", passages[3] * 3]
    for _ in range(40):  # near copies
        copy = list(passages[3] + out[6][:400])
        for at in rng.integers(0, len(copy), 3):
            copy[at] = "Z"
        out.append("".join(copy))
    return out


@pytest.mark.parametrize("group", [20_000, 3])  # with 3, most strings are counted one by one
def test_against_every_string(spark, group):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts())]
    rows.append(rows[12])
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, SCHEMA), L, GRAM, group).collect()
    want = brute([r[1] for r in rows], L)
    key = lambda x: repr(x)
    mine = sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.removed], bytes(r.kept)) for r in got), key=key)
    assert mine == sorted(((r[0], *w) for r, w in zip(rows, want)), key=key)


def test_nothing_and_null_ids(spark):
    assert suffix_dedup.suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    got = suffix_dedup.suffix_dedup(spark.createDataFrame([(None, "q" * 50, "x", "y"), (None, "no", "x", "y")], SCHEMA), L, GRAM).collect()
    assert sorted((r.doc_id, r.n_bytes, len(r.kept)) for r in got) == [(None, 2, 2), (None, 50, 0)]


@pytest.mark.parametrize("hashes_lie", [False, True])
def test_sort_and_verification(hashes_lie, monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(0, 3, 4000).astype(np.uint8)
    place = np.sort(rng.integers(50, 3900, 700))
    group = np.sort(rng.integers(0, 40, 700))
    left, right = rng.integers(0, 20, 700), rng.integers(1, 30, 700)
    suffixes = Suffixes(data, place, left, right, group)
    if hashes_lie:
        monkeypatch.setattr(suffixes.hashes, "of", lambda start, length: np.zeros(len(start), np.uint64))
    for forward in (True, False):
        order, common = suffixes.order_and_common(forward)
        exact_order, exact_common = suffixes.by_bytes(forward)
        own = lambda i: (group[i], data[place[i]:place[i] + right[i]].tobytes() if forward
                         else data[place[i] - left[i]:place[i]][::-1].tobytes())
        assert [own(i) for i in order] == [own(i) for i in exact_order]
        assert common.tolist() == exact_common.tolist()
