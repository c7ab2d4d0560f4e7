"""Spark session and cluster-facing settings.

The library never hard-codes executor sizing; it only sets the options that
change *semantics* (UTC session time zone) and enables adaptive execution so
that join strategy, skew splitting and partition coalescing are decided at
run time from real sizes.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hospiq", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's semantic settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_semantics(spark)
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Settings every operator relies on (safe to call on a shared session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


SHUFFLE_INPUT_BYTES = 4 << 20
TASK_BYTES = 16 << 20       # of shuffled data that one task reads: it compresses well, and windows hold it as rows


def size_shuffles(spark: SparkSession, folder: str) -> None:
    """Let shuffles start with a partition for each SHUFFLE_INPUT_BYTES of the
    tables in ``folder``, so that what a task sorts or holds does not grow with
    them. Adaptive execution merges small ones to TASK_BYTES; never fewer than
    the session's."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getContentSummary(path).getLength()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHUFFLE_INPUT_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What runs inside has its shuffle files deleted when it ends, not when the
    driver next collects its garbage. For writes, whose plans run once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    The setting is read from the session (or the SparkContext conf). Only
    when it is missing on a local master is a scratch folder made for the run
    (elsewhere that is an error); the cluster's setting is never overridden."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="hospiq-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(current)
    return current
