"""Phrase collocations from count streams in suffix order and in prefix order, walked in lockstep.

A text is cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words; everything is per ``lang``. Phrases of 2 to 5 words that
occur at least ``least`` times are scored by their weakest cut, floor(1000 * a * n / (l * r)), and left out where a longer frequent
phrase around them occurs (nearly) as often.

Method. Counts of all frequent phrases of 1 to 5 words are kept as a stream sorted by the reversed words, then as one sorted by
the words. In suffix order the phrases that end a phrase come before it and those that extend it to the left right after it; in
prefix order the same holds for what begins it and what extends it to the right. So one walk over a stream, with a stack as
deep as the longest phrase, gives every phrase the counts of all its endings (beginnings) and its most frequent extension:
the phrase and its parts meet as in a merge join, and no table of phrases is hashed or held.

Counting goes by length. A phrase can only be frequent if both phrases one word shorter within it are, so a scan of the texts
counts just the places where a Bloom filter of the frequent shorter ones knows both. Counts are exact, and so are the scores:
they are computed in integers of any size.

Edge cases: a null text is empty, a null lang ``und``; repeated rows count as often as they come; ties in score go to the higher
count, then the smaller phrase in byte order; an empty table gives no rows. Further columns are ignored.

Scale: a task counts a megabyte of text at a time, whose counts leave it in small batches; distinct phrases alone move, and
counts of one phrase combine before they do. Streams are cut by range wherever that falls, even within the phrases of one first word: what a walk needs from
before its first row (at most four phrases) is looked up for all ranges beforehand, a few rows per range. Filters have 16 bits a
phrase up to 64 MB. A language's report is ranked among the best of each range.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm import sketches
from kerbside.llm.common import stored

LONGEST = 5
CHUNK = 1 << 20  # bytes of text counted at a time
ROWS = 50_000  # counts that a task hands on at a time
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLAIN = bytes(
    10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c in b" \t" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def hashed(values: pa.LargeBinaryArray) -> np.ndarray:
    """64-bit hashes of the values' bytes, from running sums of a polynomial over all of them. Equal bytes have equal hashes; the
    hashes choose what is counted and never tell phrases apart."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64) + np.uint64(1)
    at = offsets - offsets[0]
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * powers(_BASE, len(data)))])
        value = (sums[at[1:]] - sums[at[:-1]]) * powers(_INVERSE, len(data) + 1)[at[:-1]]
        value ^= value >> np.uint64(32)
        value = (value + (at[1:] - at[:-1]).astype(np.uint64)) * _STEP
        return value ^ (value >> np.uint64(29))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def binary(values: Iterable[bytes]) -> pa.LargeBinaryArray:
    return pa.array(list(values), pa.large_binary())


class Words:
    """The words of some texts in order: codes, hashes, and the number of the piece and the language each stands in."""

    def __init__(self, texts: list[bytes], langs: list[str]) -> None:
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        data = np.frombuffer(b"\n".join([*texts, b""]).translate(_PLAIN), np.uint8)
        letter = (data != 10) & (data != 32)
        edges = np.flatnonzero(np.diff(letter, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        coded = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[letter])]).dictionary_encode()
        self.vocabulary = coded.dictionary
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self.piece = np.cumsum(data == 10, dtype=np.int32)[starts]
        self.langs, of_text = np.unique(np.array(langs, object), return_inverse=True)
        self.lang = of_text[np.searchsorted(np.cumsum(sizes), starts, "right")].astype(np.int64)

    def phrases(self, length: int) -> np.ndarray:
        """Places where a phrase of ``length`` words begins."""
        if len(self.codes) < length:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.piece[: len(self.piece) - length + 1] == self.piece[length - 1:])

    def phrase_hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        value = hashed(binary(x.encode() for x in self.langs))[self.lang[at]]
        words = hashed(self.vocabulary)
        with np.errstate(over="ignore"):
            for j in range(length):
                value = value * _STEP + words[self.codes[at + j]]
        return value

    def counts(self, at: np.ndarray, length: int) -> pa.RecordBatch:
        """(lang, phrase, f) of the phrases that begin at ``at``; compared by their words, not by hashes."""
        key, top = self.lang[at], max(1, len(self.langs))
        for j in range(length):
            if top * (len(self.vocabulary) + 1) >= 1 << 62:
                distinct, key = np.unique(key, return_inverse=True)
                top = len(distinct)
            key = key * len(self.vocabulary) + self.codes[at + j]
            top *= len(self.vocabulary) + 1
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        at = at[first]
        words = [self.vocabulary.take(pa.array(self.codes[at + j])) for j in range(length)]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.large_binary())) if length > 1 else words[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.langs[self.lang[at]], pa.string()), phrase.cast(pa.binary()).cast(pa.string()), pa.array(count, pa.int64())],
            names=["lang", "phrase", "f"])


def counts_in(batches: Iterable[pa.RecordBatch], length: int, shorter: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, f) of some (text, lang), chunk by chunk, at most ``ROWS`` rows together."""
    def count(texts: list[bytes], langs: list[str]) -> Iterator[pa.RecordBatch]:
        words = Words(texts, langs)
        at = words.phrases(length)
        for part in (0, 1) if shorter is not None else ():
            at = at[sketches.inside(shorter, words.phrase_hashes(at + part, length - 1))]
        for i in range(0, len(found := words.counts(at, length)), ROWS):
            yield found.slice(i, ROWS)

    texts, langs, size = [], [], 0
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            texts.append(text)
            langs.append(lang)
            size += len(text)
            if size > CHUNK:
                yield from count(texts, langs)
                texts, langs, size = [], [], 0
    if texts:
        yield from count(texts, langs)


def counted(docs: DataFrame, length: int, shorter: np.ndarray | None) -> DataFrame:
    """(lang, phrase, f): counts of phrases of ``length`` words; with ``shorter``, a Bloom filter, only of those whose two parts it knows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return counts_in(batches, length, shorter)

    plain = docs.select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return plain.mapInArrow(rows, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def known(frequent: DataFrame, length: int) -> np.ndarray:
    """A Bloom filter of frequent phrases (lang, phrase) of ``length`` words, by the hash that ``Words`` gives them."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                value = hashed(binary(x.encode() for x in batch["lang"]))
                words = [p.encode().split(b" ") for p in batch["phrase"]]
                with np.errstate(over="ignore"):
                    for j in range(length):
                        value = value * _STEP + hashed(binary(w[j] for w in words))
                yield pd.DataFrame({"hash": value.view(np.int64)})

    return sketches.bloom_of(frequent.select("lang", "phrase").mapInPandas(rows, "hash long"), frequent.count())


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of all phrases of up to ``longest`` words that occur ``least`` times, and (lang, n), all words counted."""
    with sketches.batches_of(docs.sparkSession, 256):
        counts = stored(counted(docs, 1, None), "phrases-1")
    totals = stored(counts.groupBy("lang").agg(F.sum("f").alias("n")), "phrases-n")
    levels = [counts.filter(F.col("f") >= least)]
    for length in range(2, longest + 1):
        shorter = known(levels[-1], length - 1)
        with sketches.batches_of(docs.sparkSession, 256):
            levels.append(stored(counted(docs, length, shorter).filter(F.col("f") >= least), f"phrases-{length}"))
    split = [level.select("lang", F.split("phrase", " ").alias("words"), "f") for level in levels]
    every = split[0]
    for level in split[1:]:
        every = every.unionByName(level)
    return every, totals


def ordered(stream: DataFrame, key: str, per_range: int = 100_000) -> tuple[DataFrame, dict]:
    """The stream cut into ranges of (lang, key) and sorted, and (f, greatest f of an extension) of the phrases that a range continues.

    The second has at most as many entries per range as a phrase has words.
    """
    spark = stream.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stream.count() // per_range))
    cut = stored(stream.repartitionByRange(ranges, "lang", key).withColumn("range", F.spark_partition_id()), f"phrases-by-{key}")
    begins = cut.groupBy("range").agg(F.min(F.struct("lang", key)).alias("first")).select("first.*")
    before = {(r.lang, tuple(r[key][:j])) for r in begins.collect() for j in range(1, len(r[key]))}

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple, list] = {}
        for batch in batches:
            for lang, words, f in zip(batch["lang"], map(tuple, batch[key]), batch["f"]):
                if (lang, words) in before:
                    found.setdefault((lang, words), [0, 0])[0] = f
                if (lang, words[:-1]) in before:
                    own = found.setdefault((lang, words[:-1]), [0, 0])
                    own[1] = max(own[1], f)
        yield pd.DataFrame([(lang, list(part), *v) for (lang, part), v in found.items()], columns=["lang", "part", "f", "wider"])

    crossing: dict[tuple, tuple] = {}
    if before:
        for r in cut.select("lang", key, "f").mapInPandas(met, "lang string, part array<string>, f long, wider long") \
                .groupBy("lang", "part").agg(F.max("f").alias("f"), F.max("wider").alias("wider")).collect():  # a few rows per range
            crossing[r.lang, tuple(r.part)] = (r.f, r.wider)
    return cut.repartition(ranges, "range").sortWithinPartitions("range", "lang", key), crossing


def walked(stream: DataFrame, key: str, parts: str, wider: str) -> DataFrame:
    """The stream with ``parts``, the counts of the phrases that begin a row's ``key``, shortest first, and ``wider``, that of its
    most frequent extension by one word (0: none)."""
    rows, crossing = ordered(stream, key)
    columns = [c for c in rows.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {parts} array<bigint>, {wider} bigint"

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[list] = []  # of [words, f, wider, row or None, counts of what begins it]
        here = None
        done: list[tuple] = []

        def close() -> None:
            words, _, most, row, begins = stack.pop()
            if row is not None:
                known = crossing.get((here[1], words))
                done.append((*row, begins, known[1] if known else most))

        for batch in batches:
            for row in zip(*(batch[c] for c in columns)):
                row = dict(zip(columns, row))
                words = tuple(row[key])
                if here != (row["range"], row["lang"]):
                    while stack:
                        close()
                    here = (row["range"], row["lang"])
                    for j in range(1, len(words)):  # phrases of earlier ranges
                        if (here[1], words[:j]) in crossing:
                            stack.append([words[:j], crossing[here[1], words[:j]][0], 0, None, None])
                while stack and words[:len(stack[-1][0])] != stack[-1][0]:
                    close()
                if stack and len(stack[-1][0]) == len(words) - 1:
                    stack[-1][2] = max(stack[-1][2], row["f"])
                stack.append([words, row["f"], 0, tuple(row.values()), [x[1] for x in stack]])
            yield pd.DataFrame(done, columns=[*columns, parts, wider])
            done.clear()
        while stack:
            close()
        yield pd.DataFrame(done, columns=[*columns, parts, wider])

    return rows.mapInPandas(walk, schema)


def scored(phrases: DataFrame, percent: int) -> DataFrame:
    """Phrases of two words and more that no extension stands for, with l, r and score of their weakest cut."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                a, n = int(r.f), int(r.n)
                if 100 * max(int(r.wider_left), int(r.wider_right)) >= percent * a:
                    continue
                # the score of each cut in integers of any size; min() keeps the first of equals
                cuts = [(1000 * a * n // (int(x) * int(y)), int(x), int(y)) for x, y in zip(r.begins, reversed(r.ends))]
                score, left, right = min(cuts, key=lambda c: c[0])
                out.append((r.range, r.lang, " ".join(r.words), a, left, right, n, score))
            yield pd.DataFrame(out, columns=["range", "lang", "phrase", "a", "l", "r", "n", "score"])

    return phrases.filter(F.size("words") > 1).select("range", "lang", "words", "f", "n", "begins", "ends", "wider_left", "wider_right").mapInPandas(
        rows, "range int, lang string, phrase string, a long, l long, r long, n long, score long")


def collocations(docs: DataFrame, least: int = 100, percent: int = 100, top: int = 2_000, longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase goes if a longer frequent one around it has ``percent`` % of its count. Extensions by one word decide that: what
    is longer still is no more frequent than they are.
    """
    counts, totals = frequent_phrases(docs, least, longest)
    if totals.count() <= 100_000:
        totals = F.broadcast(totals)  # that many rows at most
    counts = counts.join(totals, "lang").withColumn("key", F.reverse("words"))
    by_end = walked(counts.drop("words"), "key", "ends", "wider_left").drop("range").withColumn("words", F.reverse("key")).drop("key")
    by_start = walked(by_end, "words", "begins", "wider_right")
    result = stored(scored(by_start, percent), "phrases-scored")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    in_range = result.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "range").orderBy(*best))).filter(F.col("rank") <= top)
    ranked = in_range.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
