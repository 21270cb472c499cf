"""Collocations against plain Python that counts and compares every phrase."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kerbside.llm import collocations, sketches

SCHEMA = "doc_id long, text string, lang string, words string, range int, f string"


def rows():
    rng = random.Random(3)
    out = []
    for i in range(160):
        words = [rng.choice(["New", "york", "city", "of", "the", "THE", "é\u0085x", "a b", "w%d" % rng.randrange(40), " "]) for _ in range(rng.randrange(90))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "! "]) for w in words)
        text += " once upon a time there" * (i % 3) + " hot hot hot hot hot hot hot" * (i % 2)
        out.append((i, text, ["en", "en", "de", None][i % 4], "x", 1, "y"))
    return out + [(200, None, "en", "x", 1, "y"), (201, "", "fr", "x", 1, "y"), out[0], out[0], (None, "new york", None, "x", 1, "y"),
                  (202, "very long " * 40_000, "xx", "x", 1, "y"), (203, " .,;:!?\n ", "yy", "x", 1, "y")]


def brute(rows, least, percent, top):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i:i + m])] += 1
    frequent = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= least}
    gone = set()
    for (lang, words), f in frequent.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if 100 * f >= percent * counts[lang, words[i:i + m]]:
                    gone.add((lang, words[i:i + m]))
    out = {}
    for (lang, words), a in frequent.items():
        if (lang, words) not in gone:
            cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]], totals[lang]))
    return sorted((lang, rank, p.decode(), -a, left, right, n, -score) for lang, found in out.items()
                  for rank, (score, a, p, left, right, n) in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize("least, percent, top, per_range", [(5, 100, 2_000, 100_000), (2, 80, 25, 7), (9, 100, 3, 3)])
def test_against_all_phrases(spark, monkeypatch, least, percent, top, per_range):
    plain = collocations.ordered
    monkeypatch.setattr(collocations, "ordered", lambda stream, key: plain(stream, key, per_range))
    got = collocations.collocations(spark.createDataFrame(rows(), SCHEMA).repartition(3), least, percent, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows(), least, percent, top)


def test_no_documents(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA), 2).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, "", 1, "")] * 3, SCHEMA), 2).count() == 0


def test_chunks_and_hash_filters_change_no_count(spark, monkeypatch):
    docs = spark.createDataFrame(rows(), SCHEMA).coalesce(1)
    want, _ = collocations.frequent_phrases(docs, 4)
    full = np.full(1 << 13, 255, np.uint8)
    assert sketches.inside(full, np.arange(9, dtype=np.uint64)).all()
    monkeypatch.setattr(collocations, "known", lambda frequent, length: full)  # a full filter lets every phrase be counted
    got, _ = collocations.frequent_phrases(docs, 4)
    as_set = lambda frame: {(r.lang, tuple(r.words), r.f) for r in frame.collect()}
    assert as_set(got) == as_set(want) and len(as_set(want)) > 100


def test_scores_beyond_64_bits(spark):
    big = 1 << 62
    rows = spark.createDataFrame([(0, "en", ["a", "b"], big - 1, big + 5, [big], [big - 1], 0, 0)],
                                 "range int, lang string, words array<string>, f long, n long, begins array<long>, ends array<long>, wider_left long, wider_right long")
    [r] = collocations.scored(rows, 100).collect()
    assert r.score == 1000 * (big - 1) * (big + 5) // (big * (big - 1))


def test_a_task_counts_in_bounded_memory():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(20_000)}" for _ in range(1_500)).encode() for _ in range(1_000)]
    batches = [pa.RecordBatch.from_pydict({"text": texts[i:i + 100], "lang": ["en"] * 100}) for i in range(0, len(texts), 100)]
    total, sizes = 0, []
    tracemalloc.start()
    try:
        for found in collocations.counts_in(batches, 2, None):
            total += sum(found["f"].to_pylist())
            sizes.append(len(found))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == 1_499 * 1_000
    assert max(sizes) <= 50_000 and peak < 50 << 20
