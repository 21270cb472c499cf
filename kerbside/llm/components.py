"""Connected components by alternating stars, without gathering a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    A large star ties a node's larger neighbours to the smallest node around it, a small star its
    smaller ones. Each round writes its edges, so lineage stays short; rounds grow with the logarithm of the
    longest path.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "star-0")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(
            least.select("a", F.col("m").alias("b"))).distinct()
        now = stored(small, "star")
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
