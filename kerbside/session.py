"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job of this package expects. ``spark.sql.shuffle.partitions`` is left to the
#: cluster: AQE coalesces from a high number, so set it to a few times the total core count.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app: str = "kerbside", **conf: str) -> SparkSession:
    """A session with the package's settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in {**REQUIRED, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for name, value in REQUIRED.items():
        spark.conf.set(name, value)
    return spark


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder for checkpoints and written tables, below ``spark.checkpoint.dir``.

    The cluster names its shared folder in that setting. Only a ``local`` master may fall back to a
    folder of this machine, because there every executor is this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="kerbside-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root, f"{label}-{uuid.uuid4().hex[:12]}")
