"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app_name: str = "tillworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Shuffle sizes are left to adaptive execution: it coalesces small partitions and splits
    skewed ones, so no partition count is fixed here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even where that costs one more shuffle further up.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Bytes of a table's files for each partition of a shuffle, and of shuffled rows that adaptive execution gives to a task.
#: A byte of the line files becomes three (tallies) to eight (cleaned rows with their keys) shuffled ones.
FILE_BYTES, TASK_BYTES = 2 << 20, 8 << 20
SHUFFLES, TASK = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def fit_shuffles(spark: SparkSession, table: str) -> None:
    """Shuffles of a session for a table of this size, by the length of its files alone.

    Joins and aggregates of a task take some thirty times the memory of its compressed share. With the
    session's own settings that share grows with the input: they make a fixed number of partitions and merge
    them up to 64 MB. Here the number follows the input, never below the session's own, and they are merged
    to 8 MB, so a task's memory stays as it is while data grow.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(SHUFFLES, str(max(own, -(-size // FILE_BYTES))))
    spark.conf.set(TASK, str(TASK_BYTES))


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session that holds for a while."""
    own = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, own)


#: Whether the files of a job's shuffles go when it ends; otherwise they stay until the driver collects its garbage.
REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut lineage.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/tillworks-{name}-{uuid.uuid4().hex}"
