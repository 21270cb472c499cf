"""Topic, archive and table sinks, and taps on a flow."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kerbside.operators.timeline import union_all
from kerbside.sources.envelope import to_messages


def topic_writer(rows: DataFrame, topic: str, *, key: str | None = None, fields: list[str] | None = None,
                 bootstrap: str | None = None, path: str | None = None, checkpoint: str,
                 mode: str = "append") -> DataStreamWriter:
    """Rows as JSON messages to Kafka, or to Parquet files that hold ``key``, ``value`` and ``topic``."""
    messages = to_messages(rows, key, fields)
    writer = messages.withColumn("topic", F.lit(topic)).writeStream.outputMode(mode) \
        .option("checkpointLocation", checkpoint)
    if bootstrap:
        return writer.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    if not path:
        raise ValueError("give bootstrap or path")
    return writer.format("parquet").option("path", path)


def archive_writer(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-only Parquet archive, one folder per day of event time, so that reads prune by day."""
    dated = rows.withColumn("event_date", F.to_date("event_time"))
    return dated.writeStream.format("parquet").outputMode("append").partitionBy("event_date") \
        .option("path", path).option("checkpointLocation", checkpoint)


def start_archive(topics: Mapping[str, DataFrame], folder: str, **trigger) -> list[StreamingQuery]:
    """One running archive query per topic; wait with ``spark.streams.awaitAnyTermination()`` so that no failure hides."""
    queries = []
    for topic, rows in topics.items():
        writer = archive_writer(rows, f"{folder}/data/{topic}", f"{folder}/checkpoint/{topic}").queryName(f"archive_{topic}")
        queries.append((writer.trigger(**trigger) if trigger else writer).start())
    return queries


def write_partitioned(rows: DataFrame, path: str, by: str, mode: str = "overwrite", rows_per_file: int = 5_000_000) -> None:
    """Parquet table with one folder per value of ``by``. Rows are rebalanced by that value first: few files per folder,
    and AQE splits a value that holds much more than the others."""
    rows.hint("rebalance", by).write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy(by).parquet(path)


def tap(rows: DataFrame, tag: str) -> DataFrame:
    """Rows with a tag that says where in the flow they were seen."""
    return rows.withColumn("DEBUG_TAG", F.lit(tag))


def console_tap(rows: DataFrame, tag: str) -> DataStreamWriter:
    """Tagged rows on the console of a stream; for looking, not for production."""
    return tap(rows, tag).writeStream.format("console").option("truncate", False).outputMode("append")


def counted(rows: DataFrame, tag: str | Observation, *more: Column) -> DataFrame:
    """Count rows while they pass, without a second read; an ``Observation`` or (by name) a query listener gets the number."""
    return rows.observe(tag, F.count(F.lit(1)).alias("rows"), *more)


def tap_counts(taps: Mapping[str, DataFrame]) -> DataFrame:
    """Rows seen at each tap."""
    return union_all([
        rows.agg(F.count(F.lit(1)).alias("rows_seen")).select(F.lit(tag).alias("tag"), "rows_seen")
        for tag, rows in taps.items()
    ])


def once_writer(messages: DataFrame, path: str, checkpoint: str, by: Sequence[str] = ("key", "value"), late: str = "10 minutes",
                first: Callable[[DataFrame, int], None] | None = None) -> DataStreamWriter:
    """Messages with the effect of being written once: what a source delivers again within ``late`` of its first time, by the
    columns ``by``, is dropped in state, and each micro-batch is one transaction, the folder ``batch_id=N``, which replaces what a
    failed attempt at the same batch left. ``event_time`` carries the watermark. ``first`` is called with each batch before it is
    written; it may be called again for a batch whose write failed."""
    distinct = messages.withWatermark("event_time", late).dropDuplicatesWithinWatermark(list(by))

    def save(rows: DataFrame, batch_id: int) -> None:
        if first:
            first(rows, batch_id)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return distinct.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
