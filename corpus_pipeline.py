"""From raw documents to packed token windows, in five stages that each read what the one before wrote.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Rows with equal ids count as one document where a stage decides by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import jaccard_join, line_dedup, mixing, packing, toxicity
from kerbside.llm.common import stored, table, words_of
from kerbside.plans.catalogue import query

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go, whether labelled or not."""
    return toxicity.toxicity(docs.select(COLUMNS), table(spark, sf_dir, "labels")).filter("predicted = 0").select(COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines stay only in the document with the smallest id that holds them; no document goes."""
    cleaned = line_dedup.dedup_lines(docs.select(COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id stays."""
    verdict = jaccard_join.jaccard_components(docs)
    stays = verdict.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("stays")).distinct()
    return docs.select(COLUMNS).join(stays, F.col("doc_id").eqNullSafe(F.col("stays")), "left_semi")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; where a source's share ends inside one, its first words once more."""
    docs = docs.select(COLUMNS).withColumn("_mark", F.xxhash64("text"))
    rows = mixing.mix(docs, keep=["_mark"]).rows
    taken = rows.groupBy(F.col("doc_id").alias("_id"), "_mark").agg(
        F.floor(F.sum("taken") / F.count("*")).alias("_taken"), F.max("size").alias("_size")).filter("_taken > 0")
    part = F.col("_taken") % F.col("_size")
    times = F.concat(F.array_repeat(F.lit(0).cast("long"), F.floor(F.col("_taken") / F.col("_size")).cast("int")),
                     F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    text = F.when(F.col("_part") == 0, F.col("text")).otherwise(
        F.array_join(F.slice(words_of(F.col("text")), 1, F.col("_part").cast("int")), " "))
    joined = docs.alias("d").join(taken.alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t._id")) & (F.col("d._mark") == F.col("t._mark")))
    return joined.withColumn("_part", F.explode(times)).withColumn("text", text).withColumn(
        "n_chars", F.length("text").cast("long")).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 1024 ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("jaccard_join", one_of_each_group),
    ("mixing", mixed),
    ("packing", packed),
]

#: Learned scores and packing are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
