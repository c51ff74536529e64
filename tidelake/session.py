"""Spark session defaults and the shared folder that every executor can reach."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "tidelake", master: str | None = None,
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is designed for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: spark-submit
    supplies the first, and adaptive execution coalesces from the cluster default.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split hot join partitions even when that costs one more exchange downstream
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to all executors: the one Spark checkpoints into, from ``spark.checkpoint.dir``.

    Spark qualifies it with the scheme of its file system, so a bare path means the same folder to tasks that open files
    themselves. Whether all machines share it is the cluster's matter, as for checkpoints. Only a local session without that
    setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        # resolved, since executors of a local cluster have working directories of their own
        context.setCheckpointDir(configured or os.path.realpath(tempfile.mkdtemp(prefix="tidelake-")))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/tidelake/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Tasks a core that list the files of one read.
LISTING_TASKS = 8


@contextmanager
def grouped_listing(spark: SparkSession) -> Iterator[None]:
    """Readers made within list many paths in a few tasks a core; Spark's own default is a task for every path or directory, up to 10 000."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), LISTING_TASKS * max(1, spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(name, before)
