"""N-gram Jaccard self-join by a token-group matrix; documents linked by it fall into components.

A text's set holds the 64-bit hashes of its distinct shingles of ``words`` words (A-Z lower-cased). Documents
with equal sets are one class. Two sets link when 100 * |intersection| >= ``percent`` * |union|.

1. Of a set of n, a linked partner lacks at most miss = n * (100 - percent) / 100. Hence the first
   miss + l hashes of two linked sets, in hash order, share at least l. A text whose first hashes hardly occur in
   other texts can't link, unless as a copy; for most texts that settles it.
2. The full sets of the rest are counted: hashes in one class only can't be common, which bounds the size of a
   partner; and ordered from rare to common, linked sets share one of their first miss + 1.
3. Partition: classes with the same min-hash of their shared hashes are compared with the most typical of
   them, twice over; links found make groups. Copies of one text, however many, end as one group.
4. Token-group matrix: a cell (hash, group) says that some member has the hash in its prefix,
   with the members' smallest and largest size and largest partner. A class asks the groups larger than its own through its
   prefix; hits plus what lies beyond the prefix bound the overlap, and only groups that
   can reach the threshold are opened.
5. Members of opened groups that fit in size, and whose prefix has enough in common with the asking one for the
   threshold still to be in reach, are verified on the full sets.

Links inside a group need no further look for the components, links between groups are all found, so the components are
exact up to collisions of 64-bit hashes.

6. For the number of links, the classes of a component are cut into blocks in the order of their min-hash; blocks that
   share a prefix hash, and each block with itself, are compared whole by matrix products, and counts, not pairs, leave the task.
   A linked class counts with all its rows, a copy as one link. That takes time with the square of a component's classes.

Edge cases: null, empty and blank texts have no set and stay alone; rows with equal ids are separate and share the
id; a null id sorts after all others; ties go to the smaller id; an empty table gives an empty result; further
columns are ignored.

Scale: what is shuffled are first hashes of all sets, those among them that others may hold (by a Bloom filter of at most 64 MB), then the texts still in question (a Bloom filter of fixed size
holds the others back), then full sets of their classes. Counts are combined before their shuffle; joins on a hash that many classes
hold are plain equi-joins that adaptive execution splits. No group is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import LAST_ID, bloom_filter, filter_bits, hash_filter, small_batches, stored
from kerbside.llm.components import components
from kerbside.llm.cuckoo import mixed
from kerbside.llm.suffix_sort import Hashes

#: A block of classes whose links are counted together: so many classes, or hashes, at most (or one class), and hashes at a time.
BLOCK, BLOCK_HASHES, COLUMNS = 256, 1 << 17, 2048
#: Hashes beyond miss + 1 that the first comparison looks at, in percent of the set.
EXTRA = 3


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b" ".join(parts), np.uint8)
    blank = np.flatnonzero(data == 32)
    first, last = np.r_[0, blank + 1], np.r_[blank, len(data)]
    k = min(words, len(first))
    start = first[:len(first) - k + 1]
    return np.unique(mixed(Hashes(data).of(start, last[k - 1:] - start)))


def class_of(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    spread = mixed(hashes + np.uint64(0x5851F42D4C957F2D))
    pair = np.array([spread.sum(dtype=np.uint64), mixed(spread).sum(dtype=np.uint64)])
    return tuple(mixed(pair ^ np.uint64(len(hashes))).view(np.int64).tolist())


@dataclass(frozen=True)
class Rule:
    words: int = 4
    percent: int = 85

    def miss(self, n: int) -> int:
        return n * (100 - self.percent) // 100

    def miss_column(self, n: Column) -> Column:
        return F.floor(n * (100 - self.percent) / 100)

    def first(self, n: int) -> int:
        return min(n, self.miss(n) + 1 + n * EXTRA // 100)

    def least_shared(self, n: Column) -> Column:
        """What the first hashes of a set share at least with those of a linked one, which may be smaller."""
        smallest = F.ceil(n * self.percent / 100)
        return 1 + F.floor(smallest * EXTRA / 100)

    def links(self, common: Column, a: Column, b: Column) -> Column:
        return 100 * common >= self.percent * (a + b - common)


def measured(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, n, cls, cls2, first, row): set size, class, first hashes and a number of each row."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, rule.words) for t in batch["text"]]
            classes = np.array([class_of(s) for s in sets], np.int64).reshape(-1, 2)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n": [len(s) for s in sets], "cls": classes[:, 0], "cls2": classes[:, 1],
                                "first": [s[:rule.first(len(s))].view(np.int64) for s in sets]})

    keyed = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"), "text")
    sets = keyed.mapInPandas(rows, "doc_id long, n long, cls long, cls2 long, first array<long>")
    return stored(sets.withColumn("row", F.monotonically_increasing_id()), "jaccard-first")


def full_sets(docs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(cls, n, hashes) of the classes that share enough of their first hashes with others."""
    # a set holds a hash once, so a hash that comes twice is in two rows
    each = sets.select(F.explode("first").alias("hash"))
    shared = stored(each.groupBy("hash").agg(F.count("*").alias("df")).filter("df > 1").select("hash"), "jaccard-shared")
    may_be_shared = hash_filter(shared, filter_bits(shared.count()))

    def hits_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = np.concatenate([np.empty(0, np.int64), *batch["first"]]).astype(np.int64)
            hit = may_be_shared(hashes)
            yield pd.DataFrame({"row": np.repeat(batch["row"].to_numpy(), batch["first"].map(len))[hit], "hash": hashes[hit]})

    first = sets.select("row", "first").mapInPandas(hits_of, "row long, hash long")
    hits = first.join(shared, "hash").groupBy("row").agg(F.count("*").alias("hits"))
    open_ = stored(
        sets.drop("first").join(hits, "row").filter(F.col("hits") >= rule.least_shared(F.col("n")))
        .groupBy("cls", "cls2").agg(F.min("doc_id").alias("doc_id")), "jaccard-open")
    may_be_open = bloom_filter(open_.select("doc_id"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, cls, cls2 in zip(batch["text"], batch["cls"], batch["cls2"]):
                own = shingles(text, rule.words)
                if class_of(own) == (cls, cls2):  # another row may have the id
                    out.append((cls, len(own), own.view(np.int64)))
            yield pd.DataFrame(out, columns=["cls", "n", "hashes"])

    keyed = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"), "text").filter(may_be_open(F.col("doc_id")))
    full = stored(keyed.join(open_, "doc_id").select("text", "cls", "cls2").mapInPandas(rows, "cls long, n long, hashes array<long>"),
                  "jaccard-full")
    if full.groupBy("cls").count().filter("count > 1").isEmpty():
        return full
    return stored(full.dropDuplicates(["cls"]), "jaccard-full-once")  # a row that comes twice with its id brings its class twice


def profiles(full: DataFrame, rule: Rule) -> DataFrame:
    """Per class that may still link: size, shared hashes, largest partner, prefix from rare to common, min-hashes."""
    each = full.select("cls", F.explode("hashes").alias("hash"))
    common = each.groupBy("hash").agg(F.count("*").alias("df")).filter("df > 1")
    per_class = each.join(common, "hash").groupBy("cls").agg(
        F.sort_array(F.collect_list(F.struct("df", "hash"))).alias("shared"),
        F.min(F.xxhash64(F.lit(1), "hash")).alias("key0"), F.min(F.xxhash64(F.lit(2), "hash")).alias("key1")).join(
        full.select("cls", "n"), "cls")
    size = F.size("shared").cast("long")
    unique = F.col("n") - size
    prefix = F.slice("shared", 1, (rule.miss_column(F.col("n")) + 1 - unique).cast("int"))
    return stored(
        per_class.filter(100 * size >= rule.percent * F.col("n")).select(
            "cls", "n", size.alias("s"), "key0", "key1",
            (F.floor(size * (100 + rule.percent) / rule.percent) - F.col("n")).alias("cap"),
            F.transform(prefix, lambda x: x["hash"]).alias("prefix")),
        "jaccard-profiles")


def verified(pairs: DataFrame, full: DataFrame, rule: Rule, label: str) -> DataFrame:
    """Those of the pairs (a, b) of classes that link."""
    of = lambda c: full.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("hashes").alias(f"set_{c}"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return stored(
        pairs.join(of("a"), "a").join(of("b"), "b").filter(rule.links(common, F.col("n_a"), F.col("n_b"))).select("a", "b").distinct(), label)


def group_links(found: DataFrame, full: DataFrame, rule: Rule) -> DataFrame:
    """Links of classes to the most typical class with the same min-hash, in two rounds."""
    links = None
    for key in ("key0", "key1"):
        typical = found.groupBy(key).agg(F.max_by("cls", F.struct(F.col("s") / F.col("n"), -F.col("cls").cast("decimal(20,0)"))).alias("b"))
        pairs = found.select(F.col("cls").alias("a"), key).join(typical, key).filter("a <> b").select("a", "b")
        if links is not None:
            pairs = pairs.join(links.select("a"), "a", "left_anti")
        new = verified(pairs, full, rule, "jaccard-group-links")
        links = new if links is None else links.unionByName(new)
    return links


def matrix_links(found: DataFrame, groups: DataFrame, full: DataFrame, rule: Rule) -> DataFrame:
    """Links between classes of different groups."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    placed = (
        found.join(groups.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("grp", F.coalesce("component", "cls")).drop("component")
        .join(sizes.withColumnRenamed("component", "grp"), "grp", "left")
        .withColumn("members", F.coalesce("members", F.lit(1)))
    )
    placed = stored(placed.select("cls", "grp", "members", "n", "cap", "s", F.size("prefix").alias("p"), "prefix"), "jaccard-placed")
    cells_of = placed.select("cls", "grp", "members", "n", "cap", "s", "p", F.explode("prefix").alias("hash"))
    matrix = cells_of.groupBy("hash", "grp").agg(
        F.first("members").alias("g_members"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("cap").alias("g_cap"),
        F.max(F.col("s") - F.col("p")).alias("g_rest"))
    asked = (
        cells_of.alias("q").join(matrix.alias("g"), F.col("q.hash") == F.col("g.hash"))
        .filter(F.struct("q.members", "q.grp") < F.struct("g.g_members", "g.grp"))  # the smaller group asks
        .filter("g.low <= q.cap and q.n <= g.g_cap")
        .filter(100 * F.col("g.high") >= rule.percent * F.col("q.n"))
    )
    needed = F.ceil(rule.percent * (F.col("n") + F.col("low")) / (100 + rule.percent))
    opened = (
        asked.groupBy("q.cls", "g.grp", "q.n", "q.s", "q.p").agg(
            F.count("*").alias("hits"), F.min("g.low").alias("low"), F.max("g.g_rest").alias("g_rest"))
        .filter(F.col("hits") + F.greatest(F.col("s") - F.col("p"), "g_rest") >= needed).select("cls", "grp")
    )
    # of two prefixes the one that ends first in the common order holds all common hashes up to its end; what
    # lies beyond it in that set bounds the rest
    asking = placed.join(opened.withColumnRenamed("grp", "target"), "cls")
    rest = F.greatest(F.col("q.s") - F.col("q.p"), F.col("x.s") - F.col("x.p"))
    least = F.ceil(rule.percent * (F.col("q.n") + F.col("x.n")) / (100 + rule.percent))
    pairs = (
        asking.alias("q").join(
            placed.alias("x"),
            (F.col("q.target") == F.col("x.grp")) & F.expr("x.n <= q.cap and q.n <= x.cap")
            & (100 * F.col("x.n") >= rule.percent * F.col("q.n")) & (100 * F.col("q.n") >= rule.percent * F.col("x.n"))
            & (F.size(F.array_intersect("q.prefix", "x.prefix")) >= F.greatest(least - rest, F.lit(1))))
        .select(F.col("q.cls").alias("a"), F.col("x.cls").alias("b"))
    )
    return verified(pairs, full, rule, "jaccard-matrix-links")


def blocks_of(members: DataFrame) -> DataFrame:
    """(component, block, classes, sizes, copies, hashes, prefix): classes near in min-hash together; arrays run over the classes."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        part, made = TaskContext.get().partitionId(), 0

        def block() -> pd.DataFrame:
            return pd.DataFrame({
                "component": [held[0].component], "block": [(part << 32) + made], "classes": [[r.cls for r in held]],
                "sizes": [[len(r.hashes) for r in held]], "copies": [[r.copies for r in held]],
                "hashes": [np.concatenate([r.hashes for r in held])], "prefix": [np.unique(np.concatenate([r.prefix for r in held]))]})

        hashes = 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                if held and (r.component != held[0].component or len(held) == BLOCK or hashes + len(r.hashes) > BLOCK_HASHES):
                    yield block()
                    held, hashes, made = [], 0, made + 1
                held.append(r)
                hashes += len(r.hashes)
        if held:
            yield block()

    ordered = members.repartitionByRange("component", "key0", "cls").sortWithinPartitions("component", "key0", "cls")
    return stored(ordered.mapInPandas(
        rows, "component long, block long, classes array<long>, sizes array<long>, copies array<long>, hashes array<long>, "
        "prefix array<long>"), "jaccard-blocks")


def common_counts(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """How many hashes each set of one block has in common with each of another."""
    both = np.intersect1d(a, b)

    def places(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        column = np.searchsorted(both, hashes)
        inside = (column < len(both)) & (both[np.minimum(column, len(both) - 1)] == hashes)
        row, column = np.repeat(np.arange(len(sizes)), sizes)[inside], column[inside]
        order = np.argsort(column, kind="stable")
        return row[order], column[order]

    out = np.zeros((len(a_sizes), len(b_sizes)), np.int64)
    if not len(both):
        return out
    sides = [(*places(a, a_sizes), len(a_sizes)), (*places(b, b_sizes), len(b_sizes))]
    for start in range(0, len(both), COLUMNS):
        held = []
        for row, column, n in sides:
            lo, hi = np.searchsorted(column, (start, start + COLUMNS))
            table = np.zeros((n, COLUMNS), np.float32)
            table[row[lo:hi], column[lo:hi] - start] = 1
            held.append(table)
        out += np.rint(held[0] @ held[1].T).astype(np.int64)
    return out


def link_counts(found: DataFrame, joined: DataFrame, full: DataFrame, copies: DataFrame, rule: Rule) -> DataFrame:
    """(node, linked): rows of other classes that link to a class, for the classes of ``joined``."""
    spark = full.sparkSession
    members = stored(
        joined.withColumnRenamed("node", "cls").join(found.select("cls", "key0", "prefix"), "cls").join(copies, "cls")
        .join(full.select("cls", "hashes"), "cls"), "jaccard-members")
    blocks = blocks_of(members)
    cells = blocks.select("component", "block", F.explode("prefix").alias("hash"))
    pairs = cells.alias("p").join(cells.alias("q"), ["component", "hash"]).filter("p.block <= q.block").select(
        F.col("p.block").alias("a"), F.col("q.block").alias("b")).distinct()
    of = lambda c: blocks.select(
        F.col("block").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("classes", "sizes", "copies", "hashes")])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                a, b = np.asarray(r.sizes_a), np.asarray(r.sizes_b)
                common = common_counts(np.asarray(r.hashes_a), a, np.asarray(r.hashes_b), b)
                linked = 100 * common >= rule.percent * (a[:, None] + b - common)
                if r.a == r.b:
                    np.fill_diagonal(linked, False)
                yield pd.DataFrame({"node": r.classes_a, "linked": linked @ np.asarray(r.copies_b)})
                if r.a != r.b:
                    yield pd.DataFrame({"node": r.classes_b, "linked": np.asarray(r.copies_a) @ linked})

    small_batches(spark, 2)  # blocks, not texts
    counted = stored(pairs.join(of("a"), "a").join(of("b"), "b").mapInPandas(rows, "node long, linked long").groupBy("node").agg(
        F.sum("linked").alias("linked")), "jaccard-link-counts")
    small_batches(spark)
    return counted


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links), n_links (other rows that it links to)."""
    return _joined(docs, Rule(words, percent), counts=True)


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``jaccard_join`` without n_links, for callers who only need the components."""
    return _joined(docs, Rule(words, percent), counts=False)


def _joined(docs: DataFrame, rule: Rule, counts: bool) -> DataFrame:
    small_batches(docs.sparkSession)
    sets = measured(docs, rule)
    full = full_sets(docs, sets, rule)
    found = profiles(full, rule)
    inside = group_links(found, full, rule)
    links = inside.unionByName(matrix_links(found, components(inside), full, rule))
    joined = stored(components(links), "jaccard-components")
    # classes by component, components by their smallest document
    classes = sets.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("owner"), F.count("*").alias("copies"))
    placed = classes.withColumnRenamed("cls", "node").join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("owner").alias("component_id"))
    labels = placed.join(smallest, "component")
    if counts:
        linked = link_counts(found, joined, full, classes.select("cls", "copies"), rule)
        labels = labels.join(linked, "node", "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("linked", F.lit(0)))
    n_links = ["n_links"] if counts else []
    labels = labels.select(F.col("node").alias("cls"), "component_id", *n_links)
    null_id = lambda c: F.when(c != LAST_ID, c)
    return sets.drop("first", "cls2", "row").join(labels, "cls", "left").select(
        null_id(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
        null_id(F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))).alias("component_id"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in n_links])
