"""Starting streams: state settings, replay of files, closing records."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType

from kerbside import schemas as s
from kerbside.session import ROCKSDB, work_folder
from kerbside.sources.envelope import iso_time, to_envelope
from kerbside.sources.topics import ENVELOPE


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a stateful query keeps for life, in force while it is started.

    The number of state partitions is fixed by the first checkpoint, so choose it for the final size (a few times the
    core count). RocksDB keeps state outside the heap, and changelog checkpoints write only what a batch changed. Rows are not
    counted as they are put, which would look each of them up first.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism),
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_available(spark: SparkSession, writer: DataStreamWriter, partitions: int | None = None) -> None:
    """Process what is there, resume from the checkpoint if there is one, then stop."""
    with state_settings(spark, partitions):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    failure = query.exception()
    if failure:
        raise failure


def run_all(spark: SparkSession, writers: Sequence[DataStreamWriter], partitions: int | None = None, **trigger) -> None:
    """Start several queries and keep them running until one ends; its failure ends the others and is raised.

    Without a ``trigger`` they run on; with ``availableNow=True`` each works off what is there.
    """
    with state_settings(spark, partitions):
        queries = [(w.trigger(**trigger) if trigger else w).start() for w in writers]
    try:
        while any(q.isActive for q in queries):
            # waits on these queries alone: what else ran in this session, and how that ended, is not asked
            for query in queries:
                query.awaitTermination(1)
                if not query.isActive and not trigger:
                    break
            ended = [q for q in queries if not q.isActive]
            for query in ended:
                if query.exception():
                    raise query.exception()
            if ended and not trigger:
                return
        for query in queries:
            if query.exception():
                raise query.exception()
    finally:
        for query in queries:
            query.stop()


def closers(messages: DataFrame, after: str) -> DataFrame:
    """Valid records of an extra device, ``after`` the last message: they move the watermarks past every open window.

    A record without device, speed or limit would not do: such rows are filtered out before the watermark sees them.
    """
    end = messages.agg((F.max("timestamp") + F.expr(f"INTERVAL {after}")).alias("event_time"))
    rows = end.select(
        F.lit("closer").alias("deviceId"), F.lit("-1").alias("id"), "event_time", iso_time(F.col("event_time")).alias("timestamp"),
        F.lit(50.0).alias("speed"), F.lit(60.0).alias("SpeedLimit"), F.lit("North-East").alias("direction"),
        F.array(F.lit(s.JOURNEY_START[0]), F.lit(s.JOURNEY_START[1])).alias("location"), F.lit("0").alias("placeId"),
    )
    gps = to_envelope(rows, s.GPS_TOPIC, "id", "event_time", ["id", "deviceId", "timestamp", "speed", "direction", "location"])
    limit = to_envelope(rows, s.ROUTES_TOPIC, "id", "event_time", ["deviceId", "placeId", "timestamp", "SpeedLimit"])
    return gps.unionByName(limit)


def replay(spark: SparkSession, label: str, stages: Sequence[DataFrame], build: Callable[[DataFrame], DataFrame],
           mode: str = "append", partitions: int | None = None, files_per_batch: int = 1_000) -> DataFrame:
    """Publish messages stage by stage as files, run the stream over each stage, return all it has written.

    Every stage after the first resumes from the checkpoint of the one before. ``update`` mode output carries
    ``batch_id``.
    """
    folder = work_folder(spark, label)
    source, sink, checkpoint = f"{folder}/messages", f"{folder}/out", f"{folder}/checkpoint"
    result = None
    for messages in stages:
        messages.write.mode("append").parquet(source)
        stream = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        result = build(stream)
        writer = result.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        if mode == "append":
            writer = writer.format("parquet").option("path", sink)
        else:
            # keyed by batch, so a batch that runs again replaces its own rows
            def save(rows: DataFrame, batch_id: int) -> None:
                rows.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

            writer = writer.foreachBatch(save)
        run_available(spark, writer, partitions)
    if mode == "append":
        return spark.read.schema(result.schema).parquet(sink)
    schema = StructType([*result.schema.fields, StructField("batch_id", LongType(), True)])
    return spark.read.schema(schema).option("basePath", sink).parquet(sink)


def join_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator: int = 0,
               right_where: Column | None = None) -> DataFrame:
    """What a stream-stream join of a query keeps, read from its checkpoint as a table: ``side`` and the row's ``key`` and ``value``.

    ``batch_id``: as it stood after that batch; without, after the last one. ``right_where``, over the struct ``value``, says which
    rows of the right side count.
    """
    sides = []
    for side in ("left", "right"):
        reader = spark.read.format("statestore").option("joinSide", side).option("operatorId", operator)
        rows = (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)
        if side == "right" and right_where is not None:
            rows = rows.where(right_where)
        sides.append(rows.select(F.lit(side).alias("side"), F.to_json("key").alias("key"), F.to_json("value").alias("value")))
    return sides[0].unionByName(sides[1])
