"""The filter audit against plain Python that walks every order."""

import itertools
import random
import re

import numpy as np

from kerbside.llm import filter_audit, sketches

SCHEMA = "doc_id long, text string, source string, id string, mask string, part string"
LABELS = "doc_id long, quality int, toxic int, id string"


def rows():
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(60 if i % 3 else 400)}" for _ in range(rng.choice([30, 190, 210, 260]))) for i in range(30)]
    out = []
    for i in range(90):
        text = base[rng.randrange(30)]
        text += ["", " A$", " CAPITALS" * 9, " x|y"][rng.randrange(4)]
        out.append((i, text, ["a", "b", None, ""][i % 4], "x", "y", "z"))
    out += [(200 + i, "the very same text", "hot", "x", "y", "z") for i in range(300)]
    out += [(600, None, "a", "x", "y", "z"), (601, "", None, "x", "y", "z"), (None, "", "a", "x", "y", "z"), (None, "alone", "a", "x", "y", "z")]
    out += [out[3], out[200], (700, "é " * 70_000, "long", "x", "y", "z"), (701, "Word word\x0bx\x85" * 80, "b", "x", "y", "z")]
    return out


def labels():
    rng = random.Random(5)
    out = [(i, rng.randrange(2), rng.randrange(2), "q") for i in range(0, 700, 2)]
    return out + [(4, 1, 0, "q"), (6, None, None, "q"), (None, 1, 1, "q"), (5_000, 1, 1, "q")]


def brute(rows, labels):
    first = {}
    key = lambda i: 1 << 63 if i is None else i
    for i, t, *_ in rows:
        first[t or ""] = min(first.get(t or "", 1 << 63), key(i))
    good, toxic = {d for d, q, _, _ in labels if q == 1 and d is not None}, {d for d, _, t, _ in labels if t == 1 and d is not None}
    docs = []
    for i, t, source, *_ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if first[t] < key(i) else set()
        docs.append((source or "", fails, i in good, i in toxic))
    out = {}
    shapley = {}
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            left = [d for d in docs if d[0] == part]
            everyone = left
            for step, name in enumerate(order, 1):
                removed = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                failing = [d for d in everyone if name in d[1]]
                shapley[part, name] = shapley.get((part, name), 0) + len(removed)
                out[part, order, step] = [len(left), len(removed), len(failing) - len(removed), sum(d[1] == {name} for d in failing),
                                          sum(d[2] for d in removed), sum(d[3] for d in removed)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_against_every_order_walked(spark):
    result = filter_audit.filter_audit(spark.createDataFrame(rows(), SCHEMA).repartition(5), spark.createDataFrame(labels(), LABELS))
    got = {tuple(r[:3]): tuple(r[3:]) for r in result.collect()}
    assert got == brute(rows(), labels())
    assert dict(result.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | {
        c: "bigint" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}


def test_no_documents_and_no_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(spark.createDataFrame([], SCHEMA), none).count() == 0
    got = {tuple(r[:3]): tuple(r[3:]) for r in filter_audit.filter_audit(spark.createDataFrame(rows(), SCHEMA), none).collect()}
    assert got == brute(rows(), [])


def test_the_sketch_clears_unique_texts_and_misses_no_repeat(spark):
    rng = np.random.default_rng(1)
    once, twice = rng.integers(-1 << 62, 1 << 62, 4_000), rng.integers(-1 << 62, 1 << 62, 500)
    hashes = [int(x) for x in (*once, *twice, *twice)]
    frame = spark.createDataFrame([(h,) for h in hashes], "h long").repartition(7)
    bits = sketches.bits_for(len(hashes))
    bitmap = sketches.bitmap_of(filter_audit.repeated_cells(frame, bits, flush=300), bits)
    assert sketches.inside(bitmap, twice).all()
    assert sketches.inside(bitmap, once).mean() < 0.05


def test_a_full_sketch_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "repeated_cells", lambda hashes, bits: spark.range(bits).withColumnRenamed("id", "cell"))
    got = {tuple(r[:3]): tuple(r[3:]) for r in filter_audit.filter_audit(
        spark.createDataFrame(rows(), SCHEMA), spark.createDataFrame(labels(), LABELS)).collect()}
    assert got == brute(rows(), labels())
