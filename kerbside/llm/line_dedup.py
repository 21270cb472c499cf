"""Incremental, reversible line dedup: sharded cuckoo filters backed by an exact reference-count table.

A line's key is the line without ASCII blanks at its ends, A-Z lower-cased; keys shorter than
``min_chars`` code points are left alone. The state lies below one folder: ``log``, the exact table
with a row (shard, key, document, +1 or -1) per change, and ``filters``, a cuckoo filter per shard and
version. ``LineIndex.open`` takes a state up again; filters that a lost driver did not finish are made from the log. A key's reference count is the number of documents that hold it, its owner the smallest of
their ids. ``insert`` asks the filters first: only keys that they may know, or that the batch itself
holds twice, are looked up in the exact table, whose answer decides. New keys enter the filters; ``delete`` takes a
document's keys back and removes those without references. Deleting documents gives the state
that it would be had they never come. Deletions of unknown documents change nothing.

``dedup_lines`` brings the documents in as ``generations``, chosen by a hash of their ids: most of them at once, then what
arrives later, of which the filters say whether its keys may be known, then takes the last generation out and in again.

Keys are 128 bits of BLAKE2b of the key text; the shard comes from the key.

Edge cases: a null or empty text is one empty line; a null id stands after all others; rows with equal
ids are one document as to who holds a line, and each row is cleaned; an empty table leaves the state
as it is; further columns are kept.

Scale: keys are made distinct per document before they move, and counted per task before the shuffle, so
a line found everywhere is one row per task. A shard's filter sees distinct keys, about ``per_shard`` of
them. Texts are shuffled once, to meet the keys that they lose. Keys go to Python tasks by thousands, texts a few at a time, and
what a task held of texts leaves its Python worker with it.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import sketches
from kerbside.llm.common import BLANKS, LAST_ID, lean, small_batches, stored
from kerbside.llm.cuckoo import CuckooFilter
from kerbside.session import work_folder

KEY = ["hi", "lo"]
#: Keys that Python tasks get at a time, where no texts go with them.
KEYS_AT_A_TIME = 8192


def line_key(line: str, min_chars: int) -> bytes | None:
    key = line.strip(BLANKS)
    if len(key) < min_chars:
        return None
    return hashlib.blake2b(key.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()


def held(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, hi, lo): the distinct keys of each row."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = {k for line in (text or "").split("\n") if (k := line_key(line, min_chars))}
                ids.append(np.full(len(own), doc_id, np.int64))
                keys.extend(own)
            pair = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pd.DataFrame({"doc_id": np.concatenate(ids or [np.empty(0, np.int64)]), "hi": pair[:, 0], "lo": pair[:, 1]})

    return docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"), "text").mapInPandas(
        lean(rows), "doc_id long, hi long, lo long")


def cleaned(docs: DataFrame, losses: DataFrame, min_chars: int) -> DataFrame:
    """``docs`` without the lines whose keys ``losses`` (doc_id, hi, lo) lists for their document."""
    docs = docs.drop("n_lines", "n_dropped")
    taken = {c.lower() for c in docs.columns}
    own, gone = (next(n for k in range(len(taken) + 1) if (n := name + "_" * k) not in taken) for name in ("_id", "_lost"))
    lost = losses.groupBy(F.col("doc_id").alias(own)).agg(F.collect_list(F.struct(*KEY)).alias(gone))
    joined = docs.withColumn(own, F.coalesce(docs["doc_id"], F.lit(LAST_ID))).join(lost, own, "left").drop(own)
    joined = joined.withColumn(gone, F.transform(gone, lambda k: F.concat_ws(":", k["hi"], k["lo"])))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", n_lines long, n_dropped long"

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, counts, drops = [], [], []
            for text, lost in zip(batch["text"], batch[gone]):
                lines = (text or "").split("\n")
                keep = lines
                if lost is not None:
                    out = {np.array([int(x) for x in k.split(":")], np.int64).tobytes() for k in lost}
                    keep = [line for line in lines if line_key(line, min_chars) not in out]
                texts.append("\n".join(keep))
                counts.append(len(lines))
                drops.append(len(lines) - len(keep))
            yield batch.drop(columns=gone).assign(text=pd.Series(texts, index=batch.index, dtype=object), n_lines=counts, n_dropped=drops)

    return joined.mapInPandas(lean(apply), schema)


class LineIndex:
    """The state below ``folder``; versions of the filters and changes of the log are only ever added."""

    def __init__(self, spark: SparkSession, folder: str | None = None, min_chars: int = 10, shards: int = 16) -> None:
        self.spark, self.min_chars, self.shards = spark, min_chars, shards
        self.folder = folder or work_folder(spark, "line-index")
        self.changes: list[str] = []
        self.signs: list[int] = []
        self.filters: str | None = None
        self.asked = spark.sparkContext.accumulator(0)  # keys that filters were asked for
        small_batches(spark)
        spark.createDataFrame([(min_chars, shards)], "min_chars int, shards int").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/settings")

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> LineIndex:
        """The state that lies below ``folder``."""
        settings = spark.read.parquet(f"{folder}/settings").first()
        index = cls(spark, folder, settings.min_chars, settings.shards)
        log = spark.read.option("basePath", f"{folder}/log").parquet(f"{folder}/log")
        index.signs = [r.change for r in log.groupBy("step").agg(F.max("change").alias("change")).orderBy("step").collect()]  # a row per change
        index.changes = [f"{folder}/log/step={n}" for n in range(len(index.signs))]
        filters = spark.read.option("basePath", f"{folder}/filters").parquet(f"{folder}/filters")
        done = filters.agg(F.max("version")).first()[0]
        index.filters = f"{folder}/filters/version={done}"
        if done != len(index.changes):
            index.filters = None
            index._next_filters(index.log().select("shard", *KEY).distinct(), insert=True)
        return index

    def log(self) -> DataFrame:
        """Live rows (shard, hi, lo, doc_id): who holds which key."""
        rows = self.spark.read.parquet(*self.changes)
        if -1 not in self.signs:  # an insertion adds only what is not there, so insertions have each row once
            return rows.drop("change")
        # of documents that were ever taken out, what came and went is counted
        gone = self.spark.read.parquet(*[p for p, sign in zip(self.changes, self.signs) if sign < 0]).select("doc_id").distinct()
        live = rows.join(gone, "doc_id", "left_semi").groupBy("shard", *KEY, "doc_id").agg(F.sum("change").alias("change")).filter("change > 0")
        columns = ["shard", *KEY, "doc_id"]
        return rows.join(gone, "doc_id", "left_anti").select(columns).unionByName(live.select(columns))

    def _append(self, rows: DataFrame, change: int) -> DataFrame:
        path = os.path.join(self.folder, "log", f"step={len(self.changes)}")
        rows.withColumn("change", F.lit(change)).write.mode("overwrite").parquet(path)
        self.changes.append(path)
        self.signs.append(change)
        return self.spark.read.parquet(path).drop("change")

    def _shard(self):
        return F.pmod(F.xxhash64(*KEY), F.lit(self.shards)).cast("int")

    def _stored(self, keys: DataFrame, label: str) -> DataFrame:
        """``stored`` for rows of keys that are made without texts: in batches of many."""
        with sketches.batches_of(self.spark, KEYS_AT_A_TIME):
            return stored(keys, label)

    def _next_filters(self, keys: DataFrame, insert: bool) -> None:
        """A new version of the filters with the distinct keys (shard, hi, lo) inserted or deleted."""
        def update(keys: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            values = keys["lo"].to_numpy(np.int64).view(np.uint64)
            shard = int((keys if len(keys) else old)["shard"].iloc[0])
            filter_ = CuckooFilter.from_bytes(old["filter"].iloc[0]) if len(old) else CuckooFilter(2 * len(values))
            (filter_.insert if insert else filter_.delete)(values)
            return pd.DataFrame({"shard": [shard], "filter": [filter_.to_bytes()]})

        schema = "shard int, filter binary"
        old = self.spark.read.schema(schema).parquet(self.filters) if self.filters else self.spark.createDataFrame([], schema)
        path = os.path.join(self.folder, "filters", f"version={len(self.changes)}")
        with sketches.batches_of(self.spark, KEYS_AT_A_TIME):
            keys.groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(update, schema).write.mode("overwrite").parquet(path)
        self.filters = path

    def _known(self, keys: DataFrame) -> DataFrame:
        """Those of the distinct keys (shard, hi, lo) that the filters may know."""
        if not self.filters:
            return keys.limit(0)
        asked = self.asked

        def ask(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            if not len(filters) or not len(keys):
                return keys.iloc[:0]
            asked.add(len(keys))
            return keys[CuckooFilter.from_bytes(filters["filter"].iloc[0]).contains(keys["lo"].to_numpy(np.int64).view(np.uint64))]

        filters = self.spark.read.parquet(self.filters)
        return keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(ask, "shard int, hi long, lo long")

    @staticmethod
    def _among(rows: DataFrame, keys: DataFrame) -> DataFrame:
        """``rows`` without most of those whose key is not in ``keys`` (stored, distinct): what a join would shuffle for nothing."""
        with sketches.batches_of(keys.sparkSession, KEYS_AT_A_TIME):
            bitmap = sketches.bloom_of(keys.select("lo"), keys.count())
        return rows.filter(sketches.asked(bitmap)("lo"))

    def insert(self, docs: DataFrame) -> DataFrame:
        """Take documents in; returns the exact (hi, lo, refs, owner) of their keys that two or more documents hold."""
        rows = held(docs, self.min_chars).withColumn("shard", self._shard()).select("shard", *KEY, "doc_id").distinct()
        earlier = self.log() if self.changes else None
        if earlier is not None:  # documents that are in already add nothing
            ids = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id")).distinct()
            rows = rows.join(earlier.join(ids, "doc_id", "left_semi"), ["shard", *KEY, "doc_id"], "left_anti")
        added = self._append(rows, 1)
        batch = self._stored(added.groupBy("shard", *KEY).agg(F.count("*").alias("refs"), F.min("doc_id").alias("owner")), "line-batch")
        if earlier is None:
            self._next_filters(batch.select("shard", *KEY), insert=True)
            return batch.filter("refs > 1").select(*KEY, "refs", "owner")
        maybe = self._stored(self._known(batch.select("shard", *KEY)), "line-maybe")
        exact = self._stored(
            self._among(earlier, maybe).join(maybe, ["shard", *KEY], "left_semi").groupBy("shard", *KEY)
            .agg(F.count("*").alias("_refs"), F.min("doc_id").alias("_owner")), "line-exact")
        self._next_filters(batch.join(exact, ["shard", *KEY], "left_anti").select("shard", *KEY), insert=True)
        both = batch.join(exact, ["shard", *KEY], "left").select(
            *KEY, (F.col("refs") + F.coalesce("_refs", F.lit(0))).alias("refs"), F.least("owner", "_owner").alias("owner"))
        return both.filter("refs > 1")

    def delete(self, doc_ids: DataFrame) -> None:
        """Take documents (doc_id) out again."""
        live = self.log()
        ids = doc_ids.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id")).distinct()
        gone = self._stored(live.join(ids, "doc_id", "left_semi").select("shard", *KEY, "doc_id"), "line-gone")
        touched = self._stored(gone.select("shard", *KEY).distinct(), "line-touched")
        left = self._among(live, touched).join(ids, "doc_id", "left_anti").join(touched, ["shard", *KEY], "left_semi").select("shard", *KEY).distinct()
        freed = self._stored(touched.join(left, ["shard", *KEY], "left_anti"), "line-freed")
        self._append(gone, -1)
        self._next_filters(freed, insert=False)

    def repeated(self) -> DataFrame:
        """(hi, lo, refs, owner) of all keys that two or more documents hold now."""
        return self.log().groupBy("shard", *KEY).agg(F.count("*").alias("refs"), F.min("doc_id").alias("owner")) \
            .filter("refs > 1").drop("shard")

    def clean(self, docs: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
        """``docs``, which are in, without the lines that another document owns; adds n_lines and n_dropped."""
        repeated = self._stored(self.repeated() if repeated is None else repeated, "line-repeated")
        # written before texts are read: keys and texts in one job would share the executors' memory
        losses = self._stored(self._among(self.log(), repeated).join(repeated, KEY).filter("doc_id > owner").select("doc_id", *KEY), "line-losses")
        return cleaned(docs, losses, self.min_chars)


def shards_for(docs: DataFrame, per_shard: int = 20_000) -> int:
    """Shards so that each holds about ``per_shard`` keys; there are no more keys than lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    return max(1, -(-lines // per_shard))


def generations(docs: DataFrame, parts: int = 16) -> list[DataFrame]:
    """Most of the documents, and twice one in ``parts``, by a hash of their ids."""
    part = F.pmod(F.xxhash64(F.lit(5), F.coalesce("doc_id", F.lit(LAST_ID))), F.lit(parts))
    return [docs.filter(part > 1), docs.filter(part == 0), docs.filter(part == 1)]


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` without lines that a document with a smaller id holds; the index is built in generations."""
    index = LineIndex(docs.sparkSession, min_chars=min_chars, shards=shards_for(docs))
    parts = generations(docs.select("doc_id", "text"))
    for part in parts:
        index.insert(part)
    index.delete(parts[-1].select("doc_id"))
    index.insert(parts[-1])
    return index.clean(docs)
