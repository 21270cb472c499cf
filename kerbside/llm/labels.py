"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def training_rows(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, text, label): at most about ``most`` labelled rows outside the held-out fold.

    Rows are chosen by a hash of their id, so reruns agree; with fewer rows than ``most`` all are used. The
    ids chosen are few by that bound, so they go to every task. Rows labelled null are left out,
    an id labelled twice keeps its larger label.
    """
    usable = (
        labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null and label is not null")
        .filter(remainder(F.col("doc_id"), parts) != held_out)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    n = usable.count()
    if n > most:
        usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    return docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id")
