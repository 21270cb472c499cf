"""Packing documents into windows with their lexical neighbours.

A document is its token ids and the end id. As many whole windows as it fills are sequences of their own;
the rest, its tail, is packed with other tails. Tails are dealt into shards of about ``per_shard`` in the order of a
min-hash of their ids, so that similar ones share a shard. Each shard holds a BM25 inverted index over
its tails' ids. The longest unused tail seeds a window; the index scores all unused tails by the seed's rarest ids,
and the best that still fit enter one by one. When none fits, the best unused one is cut to fill the
window and its remainder stays in the shard, so only a shard's last window is short.

Ids equal those of the ``tokenizers`` file. ``tiktoken`` reads the same vocabulary and is about five times as fast, so
it does the work where its file exists; texts with the text of a special token go to ``tokenizers``.

Edge cases: null and empty texts are the end id alone; rows with equal ids are packed one by one; ties
go by id, start and the ids themselves; an empty table gives an empty result; further columns are ignored.

Scale: texts are tokenised once into a written table; only tails are shuffled, by range, so a group of
copies of any size spreads over as many shards as it needs. A task holds one shard's ids at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches, stored
from kerbside.llm.cuckoo import mixed

END = 0
K1, B = 1.2, 0.75
QUERY_TERMS = 16
FULL_WINDOWS = 1 << 62


class Encoder:
    """Ids of texts by one public vocabulary."""

    def __init__(self, name: str) -> None:
        import os

        import public_tokenizers as public
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = Tokenizer.from_file(public.path(f"{name}.json"))
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if os.path.exists(public.path(f"{name}.tiktoken")):
            import base64

            import tiktoken

            with open(public.path(f"{name}.tiktoken"), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(name, pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def tokenised(docs: DataFrame, tokenizer: str, window: int) -> DataFrame:
    """Stretches of documents (doc_id, doc_tokens, start, length, ids, sequence_id, order): whole windows, then the tail."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, task, made = Encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*encoder.ids(text or ""), END], "<u4")
                for start in range(0, len(ids), window):
                    part = ids[start:start + window]
                    whole, order = len(part) == window, 0
                    if whole:
                        sequence, made = FULL_WINDOWS + (task << 36) + made, made + 1
                    else:
                        sequence = -1
                        pairs = mixed(part[:-1].astype(np.uint64) << np.uint64(32) | part[1:].astype(np.uint64))
                        order = int(pairs.min() >> np.uint64(1)) if len(pairs) else 0
                    rows.append((doc_id, len(ids), start, len(part), part.tobytes(), sequence, order))
            yield pd.DataFrame(rows, columns=["doc_id", "doc_tokens", "start", "length", "ids", "sequence_id", "order"]).astype({"doc_id": "Int64"})

    schema = "doc_id long, doc_tokens long, start long, length long, ids binary, sequence_id long, order long"
    return stored(docs.select("doc_id", "text").mapInPandas(cut, schema), "packing-tokens")


class Bm25:
    """Inverted index over the ids of a shard's tails."""

    def __init__(self, tails: list[np.ndarray]) -> None:
        sizes = np.array([len(t) for t in tails])
        owner = np.repeat(np.arange(len(tails), dtype=np.int64), sizes)
        code, tf = np.unique(np.concatenate(tails).astype(np.int64) << 32 | owner, return_counts=True)
        term, self.owner = code >> 32, code & 0xFFFFFFFF
        self.terms, self.first, df = np.unique(term, return_index=True, return_counts=True)
        self.end = self.first + df
        idf = np.log1p((len(tails) - df + 0.5) / (df + 0.5))
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[self.owner] / sizes.mean()))
        by_owner = np.argsort(self.owner, kind="stable")
        number = np.repeat(np.arange(len(self.terms)), df)[by_owner]
        self.rarest, at = [], np.searchsorted(self.owner[by_owner], np.arange(len(tails) + 1))
        for a, b in zip(at[:-1], at[1:]):
            own = number[a:b]
            shared = own[df[own] > 1]
            self.rarest.append(shared[np.argsort(df[shared], kind="stable")[:QUERY_TERMS]])

    def scores(self, seed: int, n: int) -> np.ndarray:
        lists = [slice(self.first[t], self.end[t]) for t in self.rarest[seed]]
        if not lists:
            return np.zeros(n)
        return np.bincount(np.concatenate([self.owner[x] for x in lists]), np.concatenate([self.weight[x] for x in lists]), n)


def packed(tails: list[np.ndarray], window: int) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (tail, start in it, length)."""
    if not tails:
        return []
    index, n = Bm25(tails), len(tails)
    begin, left = np.zeros(n, np.int64), np.array([len(t) for t in tails])
    seeds, windows = np.argsort(-left, kind="stable"), []
    queue = list(seeds[::-1])
    while queue:
        seed = int(queue.pop())
        if not left[seed]:
            continue
        parts, room = [], window
        scores = None
        pick = seed
        while pick is not None:
            take = int(min(left[pick], room))
            parts.append((pick, int(begin[pick]), take))
            begin[pick] += take
            left[pick] -= take
            room -= take
            if not room:
                break
            if scores is None:
                scores = index.scores(seed, n)
            fits = (left > 0) & (left <= room)
            open_ = fits if fits.any() else left > 0
            pick = int(np.where(open_, scores, -1.0).argmax()) if open_.any() else None
        if left[parts[-1][0]]:  # cut: what remains can seed a window later
            queue.insert(0, parts[-1][0])
        windows.append(parts)
    return windows


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k", window: int = 1024, per_shard: int = 2000) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset); ids as little-endian 32-bit numbers."""
    stretches = tokenised(docs, tokenizer, window)
    whole = stretches.filter("sequence_id >= 0").withColumn("offset", F.lit(0).cast("long"))
    rest = stretches.filter("sequence_id < 0")
    shards = max(1, -(-rest.count() // per_shard))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = TaskContext.get().partitionId() << 32
        held: list[pd.DataFrame] = []

        def emit(shard: pd.DataFrame) -> pd.DataFrame:
            nonlocal made
            shard = shard.sort_values(["order", "doc_id", "start", "ids"], ignore_index=True)
            tails = [np.frombuffer(x, "<u4") for x in shard["ids"]]
            rows = []
            for parts in packed(tails, window):
                offset = 0
                for tail, begin, length in parts:
                    rows.append((tail, begin, length, tails[tail][begin:begin + length].tobytes(), made, offset))
                    offset += length
                made += 1
            out = pd.DataFrame(rows, columns=["tail", "begin", "length", "ids", "sequence_id", "offset"])
            own = shard.loc[out["tail"], ["doc_id", "doc_tokens", "start"]].reset_index(drop=True)
            return pd.DataFrame({"doc_id": own["doc_id"], "doc_tokens": own["doc_tokens"], "start": own["start"] + out["begin"],
                                 "length": out["length"], "ids": out["ids"], "sequence_id": out["sequence_id"], "offset": out["offset"]})

        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= 2 * per_shard:
                yield emit(pd.concat(held))
                held = []
        if held and sum(map(len, held)):
            yield emit(pd.concat(held))

    schema = "doc_id long, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long"
    tails = (
        rest.select("order", "doc_id", "doc_tokens", "start", "length", "ids")
        .repartitionByRange(shards, F.col("order"), F.col("doc_id").asc_nulls_last(), "start")
        .sortWithinPartitions("order", F.col("doc_id").asc_nulls_last(), "start", "ids")
        .mapInPandas(fill, schema)
    )
    columns = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return whole.select(columns).unionByName(tails.select(columns))
