"""Mixing sources to target weights with a low-discrepancy source schedule.

Slot ``k`` of the schedule holds the golden-ratio point ``frac((k + 1/2) * phi)``. The point falls into
one source's interval of the cumulative weights; slots are ranked within their source, and rank ``r``
reads block ``r`` of the source's shuffled stream of words, again from the first block after the last.
Any stretch of the schedule is close to the weights, and each source stops at its target.

Blocks hold ``block`` words each (a stream's last block may be shorter); the last block read is cut at
the target. A source that the schedule leaves short gets its last ranks after the end of the schedule.

Edge cases: null or blank texts have size 0 and are never taken; a null source is a source of its own,
after all others; rows with equal ids are separate documents; an empty table gives an empty result;
further columns are ignored. Sizes and targets are summed exactly, so reruns agree.

Scale: only (id, source, size) is shuffled. Running sums go over (source, hash range) and then over the
ranges, whose number follows the count of documents, ranks over (source, stretch of slots) and then over the
stretches, so no task holds a source.
The list of sources is the only thing ordered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import n_words_of, stored

GOLDEN = 0.6180339887498949
CELLS = 4096
STRETCH = 1 << 16
#: Documents that a range of a source's stream holds on average, if all are of one source.
PER_RANGE = 100_000
LEAST_BITS = 10


@dataclass
class Mix:
    """``rows``: each document with its place in the stream and the words taken; ``slots``: the schedule."""

    rows: DataFrame
    slots: DataFrame
    sources: DataFrame


def with_targets(sources: DataFrame, weights: list[int], share: float, cap: float) -> DataFrame:
    """Targets by weight; what a source can't take at ``cap`` times its size is shared again by weight."""
    everything = Window.partitionBy(F.lit(0))
    ranked = sources.withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(w) for w in weights]),
                     ((F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
                      % len(weights) + 1).cast("int")).cast("long"))
    ranked = ranked.withColumn("room", F.lit(cap) * F.col("source_size"))
    before = everything.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    level = ((F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    ranked = ranked.withColumn("level", level)
    # the first source with room for its share sets the level; all before it are full
    first = F.min(F.when(F.col("room") / F.col("weight") >= F.col("level"),
                         F.struct((F.col("room") / F.col("weight")).alias("r"), "level"))).over(everything)
    return ranked.withColumn(
        "target", F.coalesce(F.least(F.col("room"), F.col("weight") * first["level"]), F.col("room"))
    ).drop("room", "level")


def mix(docs: DataFrame, weights: list[int] = [3, 1, 2], share: float = 1.5, cap: float = 2.0,  # noqa: B006
        block: int = 256, seed: int = 17, keep: list[str] = []) -> Mix:  # noqa: B006
    """``weights`` go to the sources by code point, null last, and repeat; ``rows`` keep the columns ``keep``."""
    spark = docs.sparkSession
    sized = stored(
        docs.select("doc_id", "source", *keep, n_words_of(F.col("text")).alias("size"))
        .withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id")), "mix-sizes")
    bits = max(LEAST_BITS, (sized.count() // PER_RANGE).bit_length())
    sized = sized.withColumn("_range", F.shiftrightunsigned("_hash", 64 - bits))
    ranges = sized.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    sources = stored(
        with_targets(ranges.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, cap)
        .withColumn("n_blocks", F.ceil(F.col("source_size") / block))
        .withColumn("n_ranks", F.when(F.col("target") >= 1, _ranks(block)).otherwise(F.lit(0)).cast("long")), "mix-sources")

    # the source's shuffled stream
    offsets = ranges.withColumn("_before", F.coalesce(F.sum("_words").over(
        Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = Window.partitionBy("source", "_range").orderBy("_hash", "doc_id", "size")
    streamed = (
        sized.withColumn("_row", F.row_number().over(within))
        .withColumn("_end", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    )
    streamed = (
        streamed.alias("d").join(offsets.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source"))
                                 & (F.col("d._range") == F.col("o._range")))
        .select("d.doc_id", "d.source", "d.size", "d._range", "d._row", *[f"d.{c}" for c in keep],
                (F.col("o._before") + F.col("d._end") - F.col("d.size")).alias("start"))
    )

    slots = schedule(sources, block)
    # documents by the blocks they touch, joined with the slots that read those blocks
    touched = (
        streamed.filter("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block),
                                                  F.floor((F.col("start") + F.col("size") - 1) / block))))
        .withColumn("_from", F.greatest(F.col("start") - F.col("block") * block, F.lit(0)))
        .withColumn("_to", F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block)))
    )
    read = slots.groupBy("source", "block").agg(F.collect_list("words").alias("_reads"))
    pieces = (
        touched.alias("t").join(read.alias("r"), F.col("t.source").eqNullSafe(F.col("r.source"))
                                & (F.col("t.block") == F.col("r.block")))
        .select("t.source", "t._range", "t._row",
                F.aggregate("r._reads", F.lit(0).cast("long"),
                            lambda a, w: a + F.greatest(F.least(w, F.col("t._to")) - F.col("t._from"), F.lit(0)))
                .alias("taken"))
        .groupBy("source", "_range", "_row").agg(F.sum("taken").alias("taken"))
    )
    rows = (
        streamed.alias("d")
        .join(pieces.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))
              & (F.col("d._range") == F.col("p._range")) & (F.col("d._row") == F.col("p._row")), "left")
        .select("d.*", F.coalesce("p.taken", F.lit(0)).cast("long").alias("taken"))
        .alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("d.doc_id", "d.source", "d.size", "s.source_size", "s.target", "d.start", "d.taken", *[f"d.{c}" for c in keep])
    )
    return Mix(rows, slots, sources)


def _ranks(block: int):
    """Ranks whose first word lies before the target: whole passes, then blocks of the last pass."""
    words = F.floor("target")
    passes = F.floor(words / F.col("source_size"))
    return passes * F.col("n_blocks") + F.ceil((words - passes * F.col("source_size")) / block)


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """One row per slot that is read: position, source, rank, block of the stream, words read of it."""
    spark = sources.sparkSession
    total = sources.agg(F.sum("n_ranks")).first()[0] or 0
    everything = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    spans = (
        sources.filter("n_ranks > 0")
        .withColumn("_hi", F.sum("n_ranks").over(everything.rowsBetween(Window.unboundedPreceding, 0)) / F.lit(float(max(total, 1))))
        .withColumn("_lo", F.coalesce(F.lag("_hi").over(everything), F.lit(0.0)))
        .select("source", "_lo", F.when(F.lead("_hi").over(everything).isNull(), 1.0).otherwise(F.col("_hi")).alias("_hi"))
    )
    cells = spans.withColumn("_cell", F.explode(F.sequence(
        F.floor(F.col("_lo") * CELLS), F.least(F.floor(F.col("_hi") * CELLS), F.lit(CELLS - 1)))))
    points = (
        spark.range(total).withColumnRenamed("id", "position")
        .withColumn("_turns", (F.col("position") + 0.5) * GOLDEN)
        .withColumn("_point", F.col("_turns") - F.floor("_turns"))
        .withColumn("_cell", F.floor(F.col("_point") * CELLS))
    )
    drawn = (
        points.join(cells, "_cell").filter("_lo <= _point and _point < _hi")
        .select("position", "source", F.floor(F.col("position") / STRETCH).alias("_stretch"))
    )
    before = (
        drawn.groupBy("source", "_stretch").agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(
            Window.partitionBy("source").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    ranked = (
        drawn.withColumn("_in", F.row_number().over(Window.partitionBy("source", "_stretch").orderBy("position")) - 1)
        .alias("a").join(before.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))
                         & (F.col("a._stretch") == F.col("b._stretch")))
        .select("a.position", "a.source", (F.col("a._in") + F.col("b._before")).alias("rank"))
    )
    # ranks that the schedule has not reached follow after its end
    drawn_ranks = before.groupBy("source").agg(F.sum("_n").alias("_have"))
    late = (
        sources.alias("s").join(drawn_ranks.alias("h"), F.col("s.source").eqNullSafe(F.col("h.source")), "left")
        .select("s.source", F.col("s.n_ranks").alias("_need"), F.coalesce("h._have", F.lit(0)).alias("_have"))
        .filter("_have < _need")
        .select("source", F.explode(F.sequence(F.col("_have"), F.col("_need") - 1)).alias("rank"))
        .select((F.lit(total) + F.col("rank")).alias("position"), "source", "rank")
    )
    placed = ranked.unionByName(late).alias("a").join(
        sources.alias("s"), F.col("a.source").eqNullSafe(F.col("s.source"))).filter("a.rank < s.n_ranks")
    number = F.col("a.rank") % F.col("s.n_blocks")
    first = F.floor(F.col("a.rank") / F.col("s.n_blocks")) * F.col("s.source_size") + number * block
    return placed.select(
        "a.position", "a.source", "a.rank", number.alias("block"),
        F.least(F.lit(block), F.col("s.source_size") - number * block, F.floor("s.target") - first).cast("long").alias("words"))
