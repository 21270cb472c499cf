"""The route cache of a running job as a log-structured table: a bucketed base, one delta per batch, compaction with expiry.

``base/version=V`` holds the writes of all batches up to a certain one, in one folder per bucket of keys, ``deltas/batch_id=N``
those of batch N, ``manifest/version=V`` says up to which batch base V goes. A reader takes the newest manifest, that base
in the buckets its keys fall into, and the deltas after it: at most ``every`` of them and ``buckets`` folders, however long the
job has run. Every step is a Spark write of its own folder, so one that fails and runs again replaces what it left behind;
a base counts only once its manifest stands.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kerbside.operators.cache import TIME_TO_LIVE
from kerbside.operators.timeline import micros

WRITES = "key STRING, value STRING, event_time TIMESTAMP, id BIGINT"


@dataclass(frozen=True)
class CacheTable:
    """``ttl``: an entry's life. ``late``: by how much a read may be older than the newest write; such reads still see what
    stood at their time. ``every``: deltas after which the base is written anew."""

    spark: SparkSession
    folder: str
    ttl: str = TIME_TO_LIVE
    late: str = "1 day"
    buckets: int = 16
    every: int = 8

    def write(self, writes: DataFrame, batch_id: int) -> None:
        """The writes of a batch; of several for a key the newest. A batch that runs again replaces its own."""
        newest = writes.groupBy("key").agg(F.max(F.struct("event_time", "id", "value")).alias("w"))
        newest.select("key", "w.value", "w.event_time", "w.id").write.mode("overwrite").parquet(f"{self.folder}/deltas/batch_id={batch_id}")

    def writes_before(self, batch_id: int, keys: DataFrame | None = None) -> DataFrame:
        """The writes of earlier batches that can still be asked for; with ``keys`` (``key``) only those in their buckets."""
        version, upto = self._newest(batch_id)
        rows = self._deltas(upto, batch_id)
        if version is None:
            return rows
        base = self.spark.read.schema(f"{WRITES}, bucket INT").parquet(f"{self.folder}/base/version={version}")
        if keys is not None:
            wanted = keys.select(self._bucket().alias("bucket")).distinct()
            base = base.where(F.col("bucket").isin([r.bucket for r in wanted.collect()]))  # at most ``buckets`` numbers
        return base.drop("bucket").unionByName(rows)

    def compact(self, batch_id: int) -> bool:
        """Before batch ``batch_id`` writes: fold the deltas before it into a new base if there are ``every`` of them, without
        entries that no read can find any more. What the base before needed is removed one compaction later."""
        version, upto = self._newest(batch_id)
        if batch_id - 1 - upto < self.every:
            return False
        rows = self.writes_before(batch_id)
        horizon = F.unix_micros(F.max("event_time")) - micros(self.late)
        mark = rows.agg(horizon.alias("mark")).first().mark
        new = 0 if version is None else version + 1
        kept = rows if mark is None else self._alive(rows, mark)
        # a task writes whole buckets in the order of their keys
        kept.withColumn("bucket", self._bucket()).repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "key") \
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/base/version={new}")
        self.spark.createDataFrame([(batch_id - 1,)], "upto BIGINT").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/version={new}")
        self._remove([f"base/version={new - 2}", f"manifest/version={new - 2}"] if new > 1 else [])
        self._remove([f"deltas/batch_id={b}" for b in range(max(0, upto - self.every), upto + 1)] if version is not None else [])
        return True

    def files_before(self, batch_id: int, keys: DataFrame | None = None) -> int:
        """How many files ``writes_before`` opens."""
        return self.writes_before(batch_id, keys).select(F.input_file_name().alias("f")).where("f <> ''").distinct().count()

    def _alive(self, rows: DataFrame, mark: int) -> DataFrame:
        """Writes later than ``mark`` (µs), and the last one at or before it of each key if it still lives then."""
        at = F.unix_micros("event_time")
        last = Window.partitionBy("key").orderBy(F.desc("event_time"), F.desc("id"))
        old = rows.where(at <= mark).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
        return rows.where(at > mark).unionByName(old.where(at + micros(self.ttl) > mark))

    def _bucket(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")

    def _newest(self, batch_id: int) -> tuple[int | None, int]:
        """The newest base made of batches before ``batch_id`` alone, and the last of them."""
        try:
            rows = self.spark.read.schema("upto BIGINT, version INT").parquet(f"{self.folder}/manifest")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None, -1
        best = rows.where(F.col("upto") < batch_id).agg(F.max(F.struct("upto", "version")).alias("m")).first().m
        return (None, -1) if best is None else (best.version, best.upto)

    def _deltas(self, upto: int, batch_id: int) -> DataFrame:
        paths = [p for b in range(upto + 1, batch_id) if self._exists(p := f"{self.folder}/deltas/batch_id={b}")]
        return self.spark.read.schema(WRITES).parquet(*paths) if paths else self.spark.createDataFrame([], WRITES)

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _exists(self, path: str) -> bool:
        files, place = self._files(path)
        return files.exists(place)

    def _remove(self, names: list[str]) -> None:
        for name in names:
            files, place = self._files(f"{self.folder}/{name}")
            files.delete(place, True)
