"""Toxicity and quality: held-out accuracy, restoration, edge cases."""

import weakref
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import common, quality_gam, toxicity

WORDS = "river stone garden bright candle meadow window silver market travel yellow number kitchen letter purple winter".split()
BAD = ["idiot", "scumbag", "loser"]
DOCS = "doc_id long, text string, label string, score string"


def text(rng, n, bad=None):
    words = [WORDS[i] for i in rng.integers(0, len(WORDS), n)]
    if bad:
        words[n // 2] = bad
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        rows.append((i, text(rng, 20 + i % 40, BAD[i % 3] if toxic else None), "x", "y"))
        labels.append((i, None if i % 97 == 3 else 1, int(toxic)))
    rows += [(9000, "what an 1d10t here", "x", "y"), (9001, "such a l o s e r again", "x", "y"), (9002, "looooser of winter", "x", "y"),
             (9003, None, "x", "y"), (9004, "", "x", "y"), (9005, "winter " * 20_000, "x", "y"), (None, "river idiot", "x", "y"), rows[5],
             (9006, "$cumb@g", "x", "y"), (9007, "number 1984 and 0x1f$$$ ###", "x", "y"), (9008, "i.d.i.o.t", "x", "y")]
    labels += [(9003, 1, 0), (None, 1, 1), (5, 1, None)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(corpus):
    docs, labels = corpus
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    for r in got:
        if r.doc_id is not None and r.doc_id < 600:
            assert r.predicted == int(r.doc_id % 5 == 0)
    verdict = {r.doc_id: r.predicted for r in got}
    assert [verdict[i] for i in (9000, 9001, 9002, 9006, 9008, None)] == [1] * 6
    assert [verdict[i] for i in (9003, 9004, 9005, 9007)] == [0] * 4


def test_restoration(corpus):
    model = toxicity.trigram_model(corpus[0])
    assert toxicity.decoded("1d10t", model) == "idiot"
    assert toxicity.decoded("l-o-s-e-r", model) == "loser"
    assert toxicity.decoded("scuuumb@gg", model) == "scumbag"
    assert toxicity.decoded("winter", model) == "winter"


@pytest.mark.parametrize("text, word", [
    ("x1y,id10t", "idiot"), ("w1nd0w/l0ser", "loser"), ("river,st0ne,br1ght,$cumb@g", "scumbag"),  # every stretch of a token
    ("l0$3r!", "loser"), ("idi0+", "idiot"), ("scumb@9", "scumbag"), ("lo5e|2", "lose"), ("the idio7 here", "idiot"),  # signs at the end
    ("i. d. i. o. t", "idiot"), ("l o o s e r", "loser"), ("! d i o t", "idiot"), ("l - o - s - e - r", "loser"),  # spaced out
    ("k i t", "kit"), ("k.i.t", "kit"), ("such k-i-t!", "kit"), ("ye11ow", "yellow"),
    ("l o l o l o", "lo"), ("1.d.1.0.t", "idiot"), ("you,i.d.i.o.t,you", "idiot"), ("1 i a l o s e r", "loser")])
def test_every_disguise(corpus, text, word):
    model = toxicity.trigram_model(corpus[0])
    assert any(w.startswith(word) for w in toxicity.words_in(text, model, {}))


def test_long_stretch(corpus):
    model = toxicity.trigram_model(corpus[0])
    assert toxicity.decoded("st0ne" * 20_000, model) == "stone" * 20_000


def test_a_task_makes_lists_of_the_rows_it_reads_alone():
    model = np.random.default_rng(2).normal(size=(toxicity.N_CLASSES,) * 3).astype(np.float32)
    lists, whole = toxicity.as_lists(model), model.tolist()
    for stretch in ("1d10t", "l o s e r", "$cumb@g", "looooser", "шk0la"):
        assert toxicity.decoded(stretch, lists) == toxicity.decoded(stretch, whole)
    assert 0 < sum(map(len, lists)) < 1000


def test_tables_of_a_task_are_given_back_with_it(monkeypatch):
    class Table:
        pass

    kept, calls = [], []
    monkeypatch.setattr(common, "release", lambda: calls.append(kept[0]() is None))

    def rows(batches):
        table = Table()
        kept.append(weakref.ref(table))
        yield from batches

    assert list(common.lean(rows)(iter([1, 2]))) == [1, 2] and calls == [True]
    monkeypatch.undo()
    common.release()


def test_without_labels(spark, corpus):
    docs, labels = corpus
    assert {r.predicted for r in toxicity.toxicity(docs.limit(3), labels.limit(0)).collect()} == {0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0
    got = quality_gam.quality(docs.limit(3), labels.limit(0)).collect()
    assert len(got) == 3 and all(0 <= r.score <= 1 for r in got)


def test_quality(spark):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(500):
        good = i % 4 > 0
        words = text(rng, 60 + i % 30)
        rows.append((i, words if good else [words.upper(), words.replace(" ", "### "), " | ".join(words.split())][i % 3], "x", "y"))
        labels.append((i, int(good)))
    rows += [(9000, None, "x", "y"), (9001, "", "x", "y"), (9002, " \n ", "x", "y"), (None, "a b", "x", "y"), rows[1], (9003, "word " * 50_000, "x", "y")]
    docs = spark.createDataFrame(rows, DOCS)
    got = quality_gam.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 500]
    assert sum(r.predicted == int(r.doc_id % 4 > 0) for r in held) >= 0.97 * len(held)


def test_interactions():
    rng = np.random.default_rng(7)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    gam = quality_gam.fit(x[:2000], y[:2000])
    assert ((gam.score(x[2000:]) > 0.5) == (y[2000:] > 0)).mean() > 0.95
