"""The log-structured cache against plain lookups over all writes: content, files read, repeated batches, expiry."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from kerbside.operators.cache import cache_lookup
from kerbside.operators.cache_table import WRITES, CacheTable

BASE = datetime(2024, 1, 1)


def batch(rng, number):
    return [(f"k{rng.randrange(12)}", f"v{number}.{i}", BASE + timedelta(minutes=10 * number + rng.randrange(10)), 100 * number + i) for i in range(6)]


def newest(rows):
    best = {}
    for r in rows:
        best[r[0]] = max(best.get(r[0], (r[2], r[3], r[1])), (r[2], r[3], r[1]))
    return {(k, v, t, i) for k, (t, i, v) in best.items()}


def test_lookups_stay_right_and_files_few(spark, tmp_path):
    rng = random.Random(1)
    table = CacheTable(spark, str(tmp_path / "c"), ttl="50 minutes", late="30 minutes", buckets=4, every=4)
    written, files, folded = [], [], 0
    for number in range(26):
        folded += table.compact(number)
        if number % 5 == 4:  # reads of this time and a bit earlier
            reads = spark.createDataFrame([(f"k{k}", 1000 + k, BASE + timedelta(minutes=10 * number - back)) for k in range(13) for back in (0, 20)],
                                          "key string, id long, event_time timestamp")
            got = cache_lookup(reads, table.writes_before(number, reads), "50 minutes")
            want = cache_lookup(reads, spark.createDataFrame(written, WRITES), "50 minutes")
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
            files.append(table.files_before(number))
        rows = batch(rng, number)
        table.write(spark.createDataFrame(rows, WRITES).coalesce(1), number)
        written += sorted(newest(rows))
    assert folded == 6 and max(files) <= 4 + 4 * 2
    assert len(list((tmp_path / "c" / "base").glob("version=*"))) == 2
    assert len(list((tmp_path / "c" / "deltas").glob("batch_id=*"))) <= 10
    assert table.writes_before(26).count() < len(written)  # what no read can find is gone


def test_a_batch_that_runs_again_sees_and_leaves_the_same(spark, tmp_path):
    rng = random.Random(2)
    table = CacheTable(spark, str(tmp_path / "c"), every=2, buckets=2)
    for number in range(5):
        rows = spark.createDataFrame(batch(rng, number), WRITES)
        table.compact(number)
        before = {tuple(r) for r in table.writes_before(number).collect()}
        table.write(rows.limit(2), number)  # an attempt that was lost
        assert not table.compact(number)
        assert {tuple(r) for r in table.writes_before(number).collect()} == before
        table.write(rows, number)
    assert table.writes_before(5).where(F.col("event_time") >= BASE + timedelta(minutes=40)).count() == len(newest(map(tuple, rows.collect())))


def test_an_empty_cache(spark, tmp_path):
    table = CacheTable(spark, str(tmp_path / "c"), every=1)
    assert table.writes_before(0).count() == 0 and not table.compact(0)
    table.write(spark.createDataFrame([], WRITES), 0)
    assert table.compact(1) and table.writes_before(1).count() == 0
