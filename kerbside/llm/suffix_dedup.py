"""Suffix-array dedup: remove every byte that a string of ``length`` bytes found elsewhere too covers.

A sparse suffix array is enough. Every string of ``length`` bytes holds the smallest hash of a ``gram``-byte
substring (its anchor) at a place that its bytes alone decide, so equal strings have their anchors at equal
places. Anchors whose gram occurs once in the corpus are dropped. For the others, the context that any
string around the anchor could cover goes, once per distinct context, to the task of its gram, where contexts
are suffix-sorted to both sides (see ``suffix_sort``). The two orders tell for each distance d
before the anchor whether the string that starts there occurs again; the strings found
around one anchor overlap, so they remove one interval.

A gram with more than ``group`` distinct contexts is not gathered: its strings are counted one by one, by
the BLAKE2b hash of their bytes, as rows of their own. The result is the same.

Positions are bytes of the UTF-8 text; documents are separate, strings are judged on the input.

Edge cases: null texts are empty; texts shorter than ``length`` lose nothing; a row that comes twice is two
documents, each the other's copy; a null id is an id of its own; an empty table gives an
empty result; further columns are ignored.

Scale: a pass over the texts writes one row per distinct anchor (about 2 in ``length - gram``
bytes), which is counted and then joined; texts meet the anchors that remain, and later the intervals, in joins on the
document, which carry no hot key. A Bloom filter, sized by the count of documents up to 64 MB, keeps texts without such
anchors out of both. Counts of grams and contexts are combined before the shuffle.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import LAST_ID, bloom_filter, filter_bits, small_batches, stored
from kerbside.llm.cuckoo import mixed
from kerbside.llm.suffix_sort import Hashes, Suffixes

ROW = ["row_id", "mark"]
CONTEXT = ["gram", "hi", "lo"]
COLUMNS = [*ROW, "place", *CONTEXT, "left", "context", "n", "start", "stop"]
PAIR = "<qq"
#: Distinct contexts that a task holds before it passes them on.
HELD = 50_000
#: Bytes of texts hashed at a time.
JOINT = 1 << 16


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return values[:0]
    full = np.r_[values, np.full(-n % width, values[-1], values.dtype)].reshape(-1, width)
    ahead = pick.accumulate(full, axis=1).reshape(-1)
    behind = pick.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return pick(behind[:n - width + 1], ahead[width - 1:n])


def anchors(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per stretch of texts: the text's number, the place in it and the hash of each anchor, in order.

    An anchor is the smallest gram of some string of ``length`` bytes. Texts are hashed together, about ``JOINT`` bytes at
    a time, a longer one whole.
    """
    sizes = np.array([len(x) for x in texts], np.int64)
    stretch = np.cumsum(sizes) // JOINT
    cuts = np.flatnonzero(np.diff(stretch)) + 1
    for first, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
        data = np.frombuffer(b"".join(texts[first:stop]), np.uint8)
        if len(data) < length:
            continue
        end = np.cumsum(sizes[first:stop])
        grams = mixed(Hashes(data).windows(gram))
        smallest = sliding(grams, length - gram + 1, np.minimum)
        # a string that would run over its text's end is none
        smallest[np.repeat(end, sizes[first:stop])[:len(smallest)] - np.arange(len(smallest)) < length] = 0
        edge = np.zeros(length - gram, np.uint64)
        place = np.flatnonzero(sliding(np.r_[edge, smallest, edge], length - gram + 1, np.maximum) == grams)
        owner = np.searchsorted(end, place, side="right")
        yield first + owner, place - (end - sizes[first:stop])[owner], grams[place]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def rows_of(docs: DataFrame) -> DataFrame:
    """doc_id, row key and bytes; rows alike in id and text share the key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(LAST_ID)).alias("row_id"), F.xxhash64(text).alias("mark"),
                       text.cast("binary").alias("bytes"))


def repeated_grams(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(row_id, mark, grams): per row the anchors' grams that occur again, in the row or elsewhere."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            row_id, mark = batch["row_id"].to_numpy(), batch["mark"].to_numpy()
            for owner, _, found in anchors(list(batch["bytes"]), length, gram):
                order = np.lexsort((found, owner))
                owner, found = owner[order], found[order]
                first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])][:len(owner)])
                times = np.minimum(np.diff(np.r_[first, len(owner)]), 2)
                yield pd.DataFrame({"gram": signed(found[first]), "row_id": row_id[owner[first]], "mark": mark[owner[first]], "times": times})

    places = stored(rows.select(*ROW, "bytes").mapInPandas(emit, "gram long, row_id long, mark long, times int"), "suffix-places")
    again = places.groupBy("gram").agg(F.sum("times").alias("n")).filter("n > 1").select("gram")
    return places.drop("times").join(again, "gram").groupBy(*ROW).agg(F.collect_set("gram").alias("grams"))


def contexts(rows: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """Three kinds of rows, from one pass over the texts:

    (row_id, mark, place, gram, hi, lo): a row's distinct contexts of wanted anchors, and the first place of each;
    (row_id, mark, start, stop): what the contexts that a row holds twice cover;
    (gram, hi, lo, left, context, n): the distinct contexts of a stretch of the task, and in how many rows they are.
    """
    reach = length - gram

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, list] = {}

        def counted() -> pd.DataFrame:
            frame = pd.DataFrame([(*k, *v) for k, v in known.items()], columns=[*CONTEXT, "left", "context", "n"])
            known.clear()
            return shaped(frame)

        def covered(row: int, seen: dict[tuple, list[int]]) -> list[tuple]:
            again = [p for at in seen.values() if len(at) > 1 for p in at]
            if not again:
                return []
            size = len(texts[row])
            both = [[p - min(p, reach), min(p + length, size)] for p in again if size - p + min(p, reach) >= length]
            return [(row_ids[row], marks[row], start, stop) for start, stop in joined(both)]

        for batch in batches:
            places, spans = [], []
            texts, row_ids, marks = list(batch["bytes"]), batch["row_id"].tolist(), batch["mark"].tolist()
            repeated = np.concatenate([np.asarray(x, np.int64) for x in batch["grams"]])  # in one row, so in all
            for owner, place, found in anchors(texts, length, gram):
                keep = np.isin(signed(found), repeated)
                number, seen = -1, {}
                for row, p, g in zip(owner[keep].tolist(), place[keep].tolist(), signed(found[keep]).tolist()):
                    if row != number:
                        spans += covered(number, seen)
                        number, seen = row, {}
                        data, row_id, mark = texts[row], row_ids[row], marks[row]
                    left = min(p, reach)
                    context = data[p - left:p + length]
                    digest = hashlib.blake2b(context, digest_size=16, salt=left.to_bytes(8, "little")).digest()
                    key = (g, *struct.unpack(PAIR, digest))
                    if key not in seen:
                        seen[key] = [p]
                        places.append((row_id, mark, p, *key))
                        if key in known:
                            known[key][2] += 1
                        else:
                            known[key] = [left, context, 1]
                    else:
                        seen[key].append(p)
                spans += covered(number, seen)
                if len(places) > HELD:
                    yield shaped(pd.DataFrame(places, columns=[*ROW, "place", *CONTEXT]))
                    places = []
                if len(known) > HELD:
                    yield counted()
            yield shaped(pd.DataFrame(places, columns=[*ROW, "place", *CONTEXT]))
            yield shaped(pd.DataFrame(spans, columns=[*ROW, "start", "stop"]))
        yield counted()

    def shaped(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({c: frame[c] if c == "context" and c in frame else frame[c].astype("Int64") if c in frame
                             else pd.Series([None] * len(frame), dtype=object if c == "context" else "Int64") for c in COLUMNS})

    schema = ", ".join(f"{c} {'binary' if c == 'context' else 'long'}" for c in COLUMNS)
    return stored(rows.select(*ROW, "bytes").join(wanted, ROW).mapInPandas(emit, schema), "suffix-contexts")


def joined(spans: list) -> list[list[int]]:
    """Sorted spans with those that touch made one."""
    out: list[list[int]] = []
    for start, stop in sorted(map(list, spans)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def shared_strings(counted: DataFrame, length: int, gram: int, group: int) -> DataFrame:
    """(gram, hi, lo, smallest, largest): start distances before the anchor of strings that occur again.

    ``counted`` has a context once per stretch of a task that holds it.
    """
    hot = stored(counted.groupBy("gram").agg(F.count("*").alias("n_contexts")).filter(F.col("n_contexts") > group), "suffix-hot").select("gram")
    schema = "gram long, hi long, lo long, smallest int, largest int"

    def match(held: pd.DataFrame) -> Iterator[pd.DataFrame]:
        # rows of a context are neighbours
        first = np.flatnonzero(np.r_[True, (held[CONTEXT].to_numpy()[1:] != held[CONTEXT].to_numpy()[:-1]).any(1)])
        n = np.add.reduceat(held["n"].to_numpy(np.int64), first)
        held = held.iloc[first].reset_index(drop=True)
        size, left = held["context"].map(len).to_numpy(np.int64), held["left"].to_numpy(np.int64)
        smallest, largest = np.full(len(held), -1), np.full(len(held), -1)
        _, number, members = np.unique(held["gram"].to_numpy(np.int64), return_inverse=True, return_counts=True)
        mixed_ = np.flatnonzero(members[number] > 1)
        if len(mixed_):  # a context alone with its gram has nothing to be compared with
            data = np.frombuffer(b"".join(held["context"].iloc[mixed_]), np.uint8)
            begin = np.r_[0, np.cumsum(size[mixed_])[:-1]]
            smallest[mixed_], largest[mixed_] = Suffixes(
                data, begin + left[mixed_], left[mixed_], (size - left)[mixed_], number[mixed_], gram).shared(length)
        alike = (n > 1) & (size >= length)  # the whole context occurs again
        smallest = np.where(alike, np.maximum(0, length - (size - left)), smallest)
        largest = np.where(alike, left, largest)
        hit = largest >= 0
        yield held.loc[hit, CONTEXT].assign(smallest=smallest[hit], largest=largest[hit])

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(held) >= 8192 and held["gram"].iloc[0] != held["gram"].iloc[-1]:
                last = held["gram"] == held["gram"].iloc[-1]  # may go on in the next batch
                yield from match(held[~last].reset_index(drop=True))
                held = held[last].reset_index(drop=True)
        if held is not None and len(held):
            yield from match(held)

    def one_by_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for g, hi, lo, n, left, context in zip(*(batch[c] for c in [*CONTEXT, "n", "left", "context"])):
                for d in range(max(0, length - (len(context) - left)), left + 1):
                    digest = hashlib.blake2b(context[left - d:left - d + length], digest_size=16).digest()
                    out.append((g, hi, lo, d, *np.frombuffer(digest, np.int64).tolist(), n))
            yield pd.DataFrame(out, columns=[*CONTEXT, "d", "s_hi", "s_lo", "n"])

    few = (
        counted.join(hot, "gram", "left_anti").repartition("gram").sortWithinPartitions(*CONTEXT)
        .mapInPandas(sort, schema)
    )
    merged = counted.join(hot, "gram", "left_semi").groupBy(*CONTEXT).agg(
        F.sum("n").alias("n"), F.any_value("left").alias("left"), F.any_value("context").alias("context"))
    strings = merged.select(*CONTEXT, "n", "left", "context").mapInPandas(
        one_by_one, "gram long, hi long, lo long, d int, s_hi long, s_lo long, n long")
    string = ["gram", "d", "s_hi", "s_lo"]
    again = strings.groupBy(*string).agg(F.sum("n").alias("times")).filter("times > 1").drop("times")
    many = strings.join(again, string).groupBy(*CONTEXT).agg(F.min("d").alias("smallest"), F.max("d").alias("largest"))
    return few.unionByName(many)


def suffix_dedup(docs: DataFrame, length: int = 200, gram: int = 50, group: int = 50_000) -> DataFrame:
    """Per row: doc_id, n_bytes, ``removed`` (array of start, stop) and ``kept`` (the remaining bytes)."""
    small_batches(docs.sparkSession)
    rows = rows_of(docs)
    wanted = stored(repeated_grams(rows, length, gram), "suffix-grams")
    number = F.xxhash64(*ROW)
    may_lose = bloom_filter(wanted.select(number.alias("id")), filter_bits(wanted.count()))
    suspect = rows.filter(may_lose(number))
    found = contexts(suspect, wanted, length, gram)
    members = found.filter("place is not null")
    shared = shared_strings(found.filter("context is not null").select(*CONTEXT, "n", "left", "context"), length, gram, group)
    removed = (
        members.select(*ROW, "place", *CONTEXT).join(shared, CONTEXT)
        .select(*ROW, (F.col("place") - F.col("largest")).alias("start"), (F.col("place") - F.col("smallest") + length).alias("stop"))
        .unionByName(found.filter("start is not null").select(*ROW, "start", "stop"))
        .groupBy(*ROW).agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans, kept = [], []
            for data, starts, stops in zip(batch["bytes"], batch["starts"], batch["stops"]):
                own = [] if starts is None else joined(zip(np.asarray(starts).tolist(), np.asarray(stops).tolist()))
                edges = [0, *(x for span in own for x in span), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append([{"start": a, "stop": b} for a, b in own])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_bytes": [len(x) for x in batch["bytes"]],
                                "removed": spans, "kept": kept})

    spans = "array<struct<start:long,stop:long>>"
    losing = suspect.join(removed, ROW, "left").select("doc_id", "bytes", "starts", "stops").mapInPandas(
        cut, f"doc_id long, n_bytes long, removed {spans}, kept binary")
    # these lose nothing and need no second Python worker beside the filter's
    others = rows.filter(~may_lose(number)).select(
        "doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), F.array().cast(spans).alias("removed"), F.col("bytes").alias("kept"))
    return losing.unionByName(others)
