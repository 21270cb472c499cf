"""The join against all pairs of a fixture with families of near copies, shared passages and tiny texts."""

import re
from collections import defaultdict

import numpy as np
import pytest

from kerbside.llm import jaccard_join
from kerbside.llm.components import components

SCHEMA = "doc_id long, text string, n string, cls string, hash int"


def sets_of(text, words):
    got = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not got:
        return frozenset()
    k = min(words, len(got))
    return frozenset(tuple(got[i:i + k]) for i in range(len(got) - k + 1))


def brute(rows, words, percent):
    sets = [sets_of(t, words) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    smallest = defaultdict(lambda: 1 << 62)
    ids = [1 << 62 if r[0] is None else r[0] for r in rows]
    for i, k in enumerate(ids):
        smallest[find(i)] = min(smallest[find(i)], k)
    return sorted((k, len(s), smallest[find(i)]) for i, (k, s) in enumerate(zip(ids, sets)))


def fixture():
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: list(rng.choice(vocabulary, n))
    passage, out = text(60), [None, "", " \n\t", "One", "one", "one two", "ONE  two\n", "one two three four", "a b c d e", "É b c d", "é b c d"]
    for size, n, edits in ((80, 60, 12), (200, 60, 20), (30, 40, 4), (300, 40, 60), (150, 30, 3)):
        base = text(size)
        for _ in range(n):
            copy = list(base)
            for at in rng.integers(0, size, int(rng.integers(0, edits))):
                if rng.random() < 0.3:
                    copy[at:at + 1] = []
                    copy.append("tail")
                else:
                    copy[at] = vocabulary[int(rng.integers(0, 400))]
            out.append(" ".join(copy))
    out += [" ".join(text(int(rng.integers(5, 60))) + passage + text(int(rng.integers(5, 60)))) for _ in range(60)]
    out += [" ".join(passage), " ".join(passage).upper(), out[20], out[20], "word " * 20_000, "word " * 30_000]
    chain = text(100)  # links only between neighbours
    out += [" ".join(chain[i:] + [f"n{i}_{j}" for j in range(i)]) for i in range(0, 40, 2)]
    rows = [(int(k), t, "x", "y", 1) for k, t in zip(rng.permutation(len(out)), out)]
    return rows + [rows[30], (None, out[40], "x", "y", 1)]


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (2, 60)])
def test_components(spark, words, percent):
    rows = fixture()
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, SCHEMA), words, percent).collect()
    top = 1 << 62
    mine = sorted((top if r.doc_id is None else r.doc_id, r.n_shingles, top if r.component_id is None else r.component_id) for r in got)
    assert mine == brute(rows, words, percent)


def test_nothing(spark):
    assert jaccard_join.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_component_rounds(spark):
    rng = np.random.default_rng(1)
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1300)]
    other = [(int(a), int(b)) for a, b in rng.integers(2000, 2400, (300, 2))]
    got = {r.node: r.component for r in components(spark.createDataFrame(path + star + other + [(5, 5)], "a long, b long")).collect()}
    parent = {x: x for e in path + star + other for x in e}
    for _ in range(400):
        for a, b in path + star + other:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {k: v for k, v in parent.items() if k in got}
    assert set(got) >= {x for a, b in path + star + other if a != b for x in (a, b)}


def growing():
    """A passage, the passage with words of its own at the end, and pieces of it that are the typical sets of its min-hashes."""
    rng = np.random.default_rng(3)
    texts = []
    for family in range(25):
        base = [f"f{family}_{i}" for i in range(203)]
        texts += [base, base + [f"own{family}_{i}" for i in range(20)]]
        texts += [base[i:i + size] for size in (40, 60, 80, 100, 120) for i in range(0, 203 - size // 2, size // 2)]
    return [(int(k), " ".join(t), "x", "y", 1) for k, t in zip(rng.permutation(len(texts)), texts)]


def test_growing_texts(spark):
    rows = growing()
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, SCHEMA), 4, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 4, 85)


@pytest.mark.parametrize("block", [256, 16])
def test_links(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = fixture() + [(10_000 + i, t, "x", "y", 1) for i, (_, t, *_) in enumerate(growing()[:100])]
    rows += [(20_000 + i, " ".join([f"near{j}" for j in range(100)] + [f"own{i // 2}"]), "x", "y", 1) for i in range(60)]
    sets = [sets_of(t, 4) for _, t, *_ in rows]
    want = [sum(1 for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= 85 * len(a | b)) for i, a in enumerate(sets)]
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, SCHEMA), 4, 85).collect()
    top = 1 << 62
    assert sorted((top if r.doc_id is None else r.doc_id, r.n_links) for r in got) == sorted(
        (top if r[0] is None else r[0], n) for r, n in zip(rows, want))
    assert max(want) == 59
