"""The pipeline's stages on a small fixture, each against plain Python, and the whole run."""

import re

import numpy as np
import pytest

import corpus_pipeline
from kerbside.llm import jaccard_join

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FUNCTIONS = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    vocabulary = [f"{a}{b}" for a in "kel mor tan vis ruo".split() for b in "da lo ni su pe gra".split()]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    rows = []
    for i in range(240):
        body = "\n".join([text(30), "A line that many documents hold", text(40)])
        rows.append((i, body + (" idiot fool" if i % 6 == 0 else ""), "en", f"s{i % 3}", 0))
    rows += [(1000 + i, rows[7][1] + " tail", "en", "s0", 0) for i in range(5)] + [(2000, None, None, None, None), (2001, "", "en", "s1", 0)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = FUNCTIONS["toxicity"](spark, docs, folder)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect() if r.doc_id >= 240 or r.doc_id % 6}
    lines = FUNCTIONS["line_dedup"](spark, clean, folder)
    got = {r.doc_id: r for r in lines.collect()}
    assert got.keys() == {r.doc_id for r in clean.collect()}
    assert sum("A line that many" in r.text for r in got.values()) == 1
    assert got[1].n_chars == len(got[1].text)
    single = FUNCTIONS["jaccard_join"](spark, lines, folder)
    kept = {r.doc_id for r in single.collect()}
    groups = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(lines).collect()}
    assert kept == set(groups.values()) and single.columns == docs.columns
    mixed = FUNCTIONS["mixing"](spark, single, folder).collect()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size = {r.doc_id: words(r.text) for r in single.collect()}
    assert abs(sum(words(r.text) for r in mixed) - 1.5 * sum(size.values())) <= 4
    assert all(sum(words(r.text) for r in mixed if r.doc_id == k) <= 2 * n for k, n in size.items())


def test_run(spark, folder):
    pieces = corpus_pipeline.run(spark, folder)
    assert pieces.count() > 0
    assert {"doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"} <= set(pieces.columns)


def test_run_on_nothing(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
