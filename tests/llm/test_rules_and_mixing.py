"""Quality rules and mixing against plain Python."""

import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kerbside.llm import mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, rank int, size string, h int"
TEXTS = [None, "", " \t\n", "a b c a b c", "x " * 5000, "one line\none line\n\nother #1 |$\n one line", "Ünï wörd\x85x\x0bz",
         "the cat sat on the mat the cat sat on the mat the cat sat", "w" * 30000]


def rows():
    got = [(i, t, [None, "en", "de"][i % 3], [None, "a", "b"][i % 2 + (i > 5)], 1, "clash", 2) for i, t in enumerate(TEXTS)]
    clean = [(100 + i, " ".join(f"word{(i * 7 + j * j) % 97}x{j}" for j in range(80)), "en", "a", 1, "", 0) for i in range(150)]
    return got + clean + [clean[0]] + [(500, " ".join("$$$ ###" for _ in range(60)) + " " + " ".join(f"q{j}" for j in range(90)), "en", "a", 1, "", 0)]


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_quality_counts_and_verdicts(spark):
    frame = spark.createDataFrame(rows(), SCHEMA)
    got = quality_rules.quality_rules(frame).collect()
    assert len(got) == len(rows())
    text = {r[0]: r[1] for r in rows()}
    for r in got:
        want = counts(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    verdict = {r.doc_id: r.kept for r in got}
    assert all(verdict[100 + i] for i in range(150)) and not verdict[500]


def ratios(text):
    n_words, chars, symbols, dup_lines, repeats = counts(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    upper = len([c for c in text or "" if unicodedata.category(c) == "Lu"])
    share = lambda a, b: 10_000 * a // max(b, 1)
    return {"symbols": share(symbols, chars), "dup_lines": share(dup_lines, len(lines)), "repeats": share(repeats, n_words),
            "uppers": share(upper, chars), "word_length": share(chars, n_words)}


def in_sketch(value):
    """The lower end of the value's bucket: itself below 64, then 32 buckets per power of two."""
    width = 1 << max(0, value.bit_length() - 6)
    return value // width * width


def brute_kept(data, least, spread):
    measures = [(ratios(t), lang, source) for _, t, lang, source, *_ in data if counts(t)[0]]
    def quantile(rule, p, group):
        values = sorted(in_sketch(r[rule]) for r, *g in measures if group(*g))
        return values[-(-len(values) * p // 100) - 1], len(values)

    kept, high_fences = {}, {}
    for i, t, lang, source, *_ in data:
        n_words, *_, repeats = counts(t)
        ok = n_words >= 50 and 100 * repeats <= 50 * n_words
        for rule, value in ratios(t).items() if n_words else ():
            for group in (lambda a, b: (a, b) == (lang, source), lambda a, b: a == lang, lambda a, b: True):  # noqa: B023
                (p10, seen), (p50, _), (p90, _), (p99, _) = (quantile(rule, p, group) for p in (10, 50, 90, 99))
                if seen >= least and p99 > p50:
                    break
            high = p50 + spread * (p90 - p50) if p90 > p50 else (p50 + p99) // 2 if p99 > p50 else None
            high_fences[lang, source, rule] = high
            ok &= high is None or value <= high
            ok &= rule != "word_length" or p50 == p10 or value >= p50 - spread * (p50 - p10)
        kept[i] = ok
    return kept, high_fences


def test_fences_adapt_to_each_source(spark):
    """Two sources with symbols at different levels, one without any, a small one, ties at a fence."""
    rng = random.Random(9)
    data = []
    for source, level in (("plain", 0), ("code", 3), ("math", 9)):
        for i in range(60):
            words = [f"{rng.choice('abcdefgh')}word{rng.randrange(500)}" for _ in range(60)]
            words += ["$%#"] * (rng.randrange(level + 1) if level else 0)
            text = "\n".join(" ".join(words[j:j + 9]) for j in range(0, len(words), 9)) + "\nsame\nsame" * rng.randrange(3)
            data.append((len(data), text + (" ###" * 60 if i % 20 == 7 else ""), "en", source, 1, "", 0))
    data += [(1000 + i, data[i][1], "en", "tiny", 1, "", 0) for i in range(5)] + [(2000, None, "en", "plain", 1, "", 0), (2001, "short", None, None, 1, "", 0)]
    got = quality_rules.quality_rules(spark.createDataFrame(data, SCHEMA), least=40)
    want, fences = brute_kept(data, 40, 5)
    assert {r.doc_id: r.kept for r in got.collect()} == want
    assert len({fences["en", s, "symbols"] for s in ("plain", "code", "math")}) == 3
    assert 0 < sum(not v for v in want.values()) < 40


def test_sketch_buckets_and_merging(spark):
    values = spark.range(0, 200_000, 7).select(F.col("id").alias("x"))
    off = values.select((F.col("x") - quality_rules.value_of(quality_rules.bucket_of(F.col("x")))).alias("d"), "x")
    assert off.filter("d < 0 or d * 32 > x").count() == 0
    sketch = spark.createDataFrame([("en", "a", "r", 3, 2), ("en", "b", "r", 3, 5), ("en", "b", "r", 9, 1)],
                                   "lang string, source string, rule string, bucket long, n long")
    assert {tuple(r) for r in quality_rules.merged(sketch, "lang").collect()} == {("en", "r", 3, 7), ("en", "r", 9, 1)}


def test_quality_of_an_empty_table(spark):
    assert quality_rules.quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((k for k in sizes if k is not None)) + [k for k in sizes if k is None]
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    full, left = set(), share * sum(sizes.values())
    while True:
        free = [k for k in names if k not in full]
        level = left / sum(weight[k] for k in free) if free else 0
        over = [k for k in free if weight[k] * level > cap * sizes[k] + 1e-9]
        if not over:
            return {k: cap * sizes[k] if k in full else weight[k] * level for k in names}
        full |= set(over)
        left -= sum(cap * sizes[k] for k in over)


@pytest.mark.parametrize("block", [16, 256])
def test_mixing_reaches_its_targets(spark, block):
    data = [(i, " ".join(["w"] * (i % 40)), "en", ["a", "b", None, "cé", "big"][min(i % 9, 4)], 1, "", 0) for i in range(900)]
    data += [(9999, "long " * 3000, "en", "a", 1, "", 0), (5, None, "en", "a", 1, "", 0), data[3]]
    mix = mixing.mix(spark.createDataFrame(data, SCHEMA), block=block)
    got = mix.rows.collect()
    assert len(got) == len(data)
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r["size"]
    want = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
    assert all(abs(taken[k] - want[k]) <= 1 for k in sizes)
    again = mixing.mix(spark.createDataFrame(data[::-1], SCHEMA), block=block).rows.collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    order = [r.source for r in mix.slots.orderBy("position").collect()]
    share = Counter(order[:len(order) // 2])
    for k in sizes:  # half of the schedule already shows the weights
        assert abs(share[k] - want[k] / sum(want.values()) * (len(order) // 2)) <= 6


def test_mixing_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).rows.count() == 0
    assert [r.taken for r in mixing.mix(spark.createDataFrame([(1, None, None, None, 1, "", 0)], SCHEMA)).rows.collect()] == [0]
