"""How five document filters act together, in every order, per source: a counting-Bloom prepass and additive mask counts.

The filters (a text's words are maximal runs without ASCII blanks; case counts): A fewer than 200 words, B fewer than
half of the words distinct, C capitals A-Z above 2 % of the code points, D any of ``#$%&*|``, E a smaller doc_id somewhere
in the table has the same text.

Method. One scan gives each row its mask of A to D and a 64-bit hash of its text. Every task counts the hashes into a
counting Bloom sketch, whose counters stop at two; sketches merge by adding counters. A text with a counter of one is
guaranteed unique and cleared. Only the rest, possible repeats, move their whole texts to an exact minimum of doc_id per
text; the row that has it passes E, the others fail. Masks are then counted per source, with the good and toxic labels, and
everything reported is a sum over at most 32 masks: which row a filter removes depends on its mask and the order alone.

Edge cases: a null text is empty, a null source the empty string, a null doc_id greater than all others. Rows equal in id
and text are copies of each other but of no smaller id. A document with several label rows is good (toxic) if one says 1;
labels of other documents, and null ones, count nowhere. An empty table gives no rows. Further columns are ignored.

Scale: the text is scanned twice and shuffled only where the sketch does not clear it; equal texts combine in the task before
they move, so a text that a third of all rows share is one row per task. The sketch has 16 bits a row up to 64 MB; beyond,
it clears fewer texts and more of them move. Joins are on ids, which repeat only where the table repeats its rows.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm import sketches
from kerbside.llm.common import LAST_ID, stored

FILTERS = "ABCDE"
REPEATS = 1 << 4
SIGNS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))


def own_mask(text: bytes) -> int:
    """Bits of A to D for one text in UTF-8."""
    words = text.split()  # of bytes: at ASCII blanks alone
    code_points = len(text.decode("utf-8", "replace"))
    return (
        (len(words) < 200)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * (len(text) - len(text.translate(None, CAPITALS))) > 2 * code_points) << 2
        | (len(text.translate(None, SIGNS)) < len(text)) << 3
    )


def masked(docs: DataFrame) -> DataFrame:
    """(id, part, mask, hash): a row per document, its text reduced to the mask of A to D and a hash."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(mask=np.array([own_mask(t) for t in batch.pop("bytes")], np.int32))[["id", "part", "mask", "hash"]]

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("hash"), text.cast("binary").alias("bytes"),
    ).mapInPandas(rows, "id long, part string, mask int, hash long")


def repeated_cells(hashes: DataFrame, bits: int, flush: int = 1 << 20) -> DataFrame:
    """(cell): counters of the counting Bloom sketch of ``hashes`` (one BIGINT column) that are above one."""
    column = hashes.columns[0]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[np.ndarray] = []

        def sketch() -> pd.DataFrame:
            cells, counts = np.unique(np.concatenate(kept), return_counts=True)
            kept.clear()
            return pd.DataFrame({"cell": cells.view(np.int64), "n": np.minimum(counts, 2)})

        for batch in batches:
            kept.extend(sketches.places(batch[column].to_numpy(np.int64), bits))
            if sum(map(len, kept)) > flush:
                yield sketch()
        if kept:
            yield sketch()

    return hashes.mapInPandas(partial, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).filter("n > 1").select("cell")


def flagged(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (of ``masked``) with the bit of E in their masks."""
    bits = sketches.bits_for(rows.count())
    maybe = sketches.asked(sketches.bitmap_of(repeated_cells(rows.select("hash"), bits), bits))
    text = F.coalesce(F.col("text"), F.lit(""))
    owners = (
        docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), text.alias("text"))
        .filter(maybe(F.xxhash64("text")))
        .groupBy("text").agg(F.min("id").alias("id"))
        .select("id", F.xxhash64("text").alias("hash")).distinct().withColumn("first", F.lit(True))
    )
    cleared = rows.withColumn("maybe", maybe("hash"))
    again = cleared.filter("maybe").drop("maybe").join(owners, ["id", "hash"], "left")
    again = again.withColumn("mask", F.when(F.col("first").isNull(), F.col("mask").bitwiseOR(REPEATS)).otherwise(F.col("mask")))
    return cleared.filter("NOT maybe").drop("maybe").unionByName(again.drop("first"))


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled good or toxic, per source and mask."""
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return rows.join(known, "id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def orders(filters: str = FILTERS) -> list[dict]:
    """Every step of every order: the filter's bit and the bits of those before it."""
    out = []
    for order in itertools.permutations(filters):
        before = 0
        for step, name in enumerate(order, 1):
            own = 1 << filters.index(name)
            out.append({"filter_order": "".join(order), "step": step, "own": own, "before": before})
            before |= own
    return out


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """All steps of all orders per part, from counts (part, mask, n, good, toxic); bit i of a mask: it fails ``filters[i]``."""
    steps = F.from_json(F.lit(json.dumps(orders(filters))), "array<struct<filter_order:string,step:int,own:int,before:int>>")
    at = counts.withColumn("at", F.explode(steps)).select("part", "mask", "n", "good", "toxic", "at.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(when: Column, of: Column | str = "n") -> Column:
        return F.sum(F.when(when, F.col(of) if isinstance(of, str) else of).otherwise(0)).cast("long")

    # of n! orders a mask of b bits meets each of its filters first in n! / b
    n_orders = len(orders(filters)) // len(filters)
    share = F.element_at(F.array(*[F.lit(n_orders // b) for b in range(1, len(filters) + 1)]), F.greatest(F.bit_count("mask"), F.lit(1)))
    return at.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails).alias("kept"), total(~gone & fails).alias("removed"), total(gone & fails).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"), total(~gone & fails, "good").alias("good_lost"),
        total(~gone & fails, "toxic").alias("toxic_lost"), total(fails, F.col("n") * share).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per source, order of the five filters and step."""
    with sketches.batches_of(docs.sparkSession, 256):
        rows = stored(masked(docs), "audit-masks")
    with sketches.batches_of(docs.sparkSession, 10_000):
        counts = stored(mask_counts(flagged(docs, rows), labels), "audit-counts")
    return audit(counts)
