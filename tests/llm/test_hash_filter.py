"""The Bloom filter of hashes that arrays are asked against, and what the Jaccard join shuffles behind it."""

import numpy as np
from pyspark.sql import functions as F

from kerbside.llm import common
from kerbside.llm import jaccard_join as jj
from kerbside.llm.common import bloom_filter, filter_bits, hash_filter


def test_no_hash_is_missed_and_few_others_pass(spark):
    rng = np.random.default_rng(1)
    inside, others = rng.integers(-1 << 62, 1 << 62, (2, 5_000))
    test = hash_filter(spark.createDataFrame([(int(v),) for v in inside], "hash long"), filter_bits(len(inside)))
    assert test(inside).all() and test(others).mean() < 0.01
    assert len(test(np.empty(0, np.int64))) == 0
    assert not hash_filter(spark.createDataFrame([], "hash long"), filter_bits(0))(others).any()


def test_sets_without_a_shared_hash_send_none(spark):
    words = lambda seed, n=60: " ".join(f"w{seed}x{i}" for i in range(n))
    texts = {i: words(i) for i in range(20)} | {100: words(3) + " end", 101: None, 102: "", 103: words(5)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    asked = []
    original = jj.hash_filter

    def seen(hashes, bits):
        asked.append(sorted(r[0] for r in hashes.collect()))
        return original(hashes, bits)

    jj.hash_filter = seen
    try:
        got = {r["doc_id"]: r["component_id"] for r in jj.jaccard_join(docs, 4, 85).collect()}
    finally:
        jj.hash_filter = original
    assert got == {i: {100: 3, 103: 5}.get(i, i) for i in texts}
    own = [set(jj.shingles(texts[i], 4)[:jj.Rule(4, 85).first(57)].view(np.int64).tolist()) for i in (5, 3)]
    assert own[0] <= set(asked[0]) <= own[0] | set(jj.shingles(texts[3], 4).view(np.int64).tolist())
    assert docs.agg(F.count("*")).first()[0] == 24


def test_a_filter_takes_few_jobs_whatever_the_partitions(spark, monkeypatch):
    rng = np.random.default_rng(2)
    inside, others = rng.integers(-1 << 62, 1 << 62, (2, 3_000))
    ids = spark.createDataFrame([(int(v),) for v in inside], "id long")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.sparkContext.setJobGroup("filters", "filters")
        test, column = hash_filter(ids, 1 << 20), bloom_filter(ids, 1 << 20)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("filters")
        assert 0 < len(jobs) <= 12  # one per shuffle, not one per partition
        monkeypatch.setattr(common, "SEGMENTS", 1)  # taken in two steps
        again = hash_filter(ids, 1 << 20)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in held.items():
            spark.conf.set(k, v)
    assert test(inside).all() and test(others).mean() < 0.01
    assert (again(inside) == test(inside)).all() and (again(others) == test(others)).all()
    passed = lambda values: spark.createDataFrame([(int(v),) for v in values], "id long").filter(column(F.col("id"))).count()
    assert passed(inside) == len(inside) and passed(others) < 30
