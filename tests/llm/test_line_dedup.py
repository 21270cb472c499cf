"""Line dedup against plain Python, and its state after insertions and deletions."""

import hashlib
import shutil
from collections import defaultdict

import numpy as np

from kerbside.llm import line_dedup
from kerbside.llm.cuckoo import CuckooFilter

SCHEMA = "doc_id long, text string, hi string, shard string"
LINES = ["A shared line here", "  a SHARED line here\t", "short", "sh or tt", "ünïque line ÄÖ", "ünïque line äö", "", "only once, number "]


def docs():
    out = [(i, "\n".join(LINES[(i * 3 + j) % 7] for j in range(i % 6 + 1)) + f"\nonly once, number {i}", "x", "y") for i in range(60)]
    return out + [(70, None, "x", "y"), (71, "", "x", "y"), (72, "x" * 100_000 + "\n" + LINES[0], "x", "y"), out[5], (None, LINES[0] + "\nq", "x", "y")]


def key(line):
    k = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in k) if len(k) >= 10 else None


def brute(rows):
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if key(line):
                holders[key(line)].add(1 << 62 if i is None else i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        me = 1 << 62 if i is None else i
        keep = [x for x in lines if not key(x) or len(holders[key(x)]) < 2 or min(holders[key(x)]) == me]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in frame.collect()), key=repr)


def test_one_batch(spark):
    frame = spark.createDataFrame(docs(), SCHEMA)
    result = line_dedup.dedup_lines(frame)
    assert result.columns == ["doc_id", "text", "hi", "shard", "n_lines", "n_dropped"]
    assert got(result) == brute(docs())
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_batches_and_deletions(spark):
    rows = docs()[:60]
    index = line_dedup.LineIndex(spark, shards=3)
    for part in (rows[10:30], rows[30:], rows[:10] + rows[20:25]):  # some come again
        frame = spark.createDataFrame(part, SCHEMA)
        repeated = index.insert(frame)
    everything = spark.createDataFrame(rows, SCHEMA)
    assert got(index.clean(everything)) == brute(rows)
    assert {(r.hi, r.lo) for r in repeated.collect()} <= {(r.hi, r.lo) for r in index.repeated().collect()}
    gone = {0, 1, 2, 9, 33, 1234}
    index.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
    rest = [r for r in rows if r[0] not in gone]
    assert got(index.clean(spark.createDataFrame(rest, SCHEMA))) == brute(rest)
    # the filters know the keys that live on, and hardly any that went
    keys = index.log().select("shard", "hi", "lo").distinct()
    assert index._known(keys).count() == keys.count()
    index.insert(spark.createDataFrame([r for r in rows if r[0] in gone], SCHEMA))
    assert got(index.clean(everything)) == brute(rows)


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 40_000).astype(np.uint64)
    f = CuckooFilter(1000)
    for part in np.array_split(keys, 7):
        f.insert(part)
    f = CuckooFilter.from_bytes(f.to_bytes())
    assert f.contains(keys).all()
    assert f.contains(rng.integers(0, 1 << 63, 40_000).astype(np.uint64)).mean() < 0.003
    f.delete(keys[:30_000])
    assert f.contains(keys[30_000:]).all()
    assert f.contains(keys[:30_000]).mean() < 0.003
    assert not CuckooFilter().contains(keys[:5]).any()


def test_same_digest_for_equal_lines():
    assert line_dedup.line_key(" Same LINE here ", 10) == hashlib.blake2b(b"same line here", digest_size=16).digest()


def test_the_query_asks_the_filters(spark, monkeypatch):
    made = []
    plain = line_dedup.LineIndex.__init__
    monkeypatch.setattr(line_dedup.LineIndex, "__init__", lambda self, *a, **b: (plain(self, *a, **b), made.append(self))[0])
    rows = [(i, "\n".join(LINES[(i * 3 + j) % 7] for j in range(i % 6 + 1)) + f"\nonly once, number {i}", "x", "y") for i in range(200)]
    assert got(line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    [index] = made
    assert index.asked.value > 20 and index.signs == [1, 1, 1, -1, 1]


def test_columns_named_as_the_operator_names_its_own(spark):
    frame = spark.createDataFrame([(*r[:2], 5, "l", 1, 2) for r in docs()], "doc_id long, text string, _id int, _lost string, n_lines int, n_dropped int")
    result = line_dedup.dedup_lines(frame)
    assert result.columns == ["doc_id", "text", "_id", "_lost", "n_lines", "n_dropped"]
    assert got(result) == brute(docs()) and {(r["_id"], r["_lost"]) for r in result.collect()} == {(5, "l")}


def test_a_state_is_taken_up_again(spark, tmp_path):
    rows, folder = docs()[:60], str(tmp_path / "index")
    index = line_dedup.LineIndex(spark, folder, shards=3)
    index.insert(spark.createDataFrame(rows[:30], SCHEMA))
    index.insert(spark.createDataFrame(rows[30:45], SCHEMA))
    index.delete(spark.createDataFrame([(i,) for i in range(5)], "doc_id long"))
    index = line_dedup.LineIndex.open(spark, folder)
    index.insert(spark.createDataFrame(rows[45:], SCHEMA))
    shutil.rmtree(f"{folder}/filters/version=4")  # the driver was lost before it had written them
    index = line_dedup.LineIndex.open(spark, folder)
    index.insert(spark.createDataFrame(rows[:5], SCHEMA))
    assert got(index.clean(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    keys = index.log().select("shard", "hi", "lo").distinct()
    assert index._known(keys).count() == keys.count()


def test_keys_go_to_python_in_large_batches_and_losses_are_written_before_texts_are_read(spark, monkeypatch):
    name, plain, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", line_dedup.stored, {}

    def stored(frame, label):
        seen[label] = int(spark.conf.get(name))
        return plain(frame, label)

    monkeypatch.setattr(line_dedup, "stored", stored)
    result = line_dedup.dedup_lines(spark.createDataFrame(docs(), SCHEMA))
    assert set(seen) == {f"line-{x}" for x in ("batch", "maybe", "exact", "gone", "touched", "freed", "repeated", "losses")}
    assert min(seen.values()) >= 4096 and int(spark.conf.get(name)) == 256  # texts still go a few at a time
    assert got(result) == brute(docs())
