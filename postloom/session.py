"""Session settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that results depend on: text timestamps without a zone are read as UTC.
RESULT_CONF = {"spark.sql.session.timeZone": "UTC"}

# How tables and streams of whole posts are stored: far smaller than by the default codec.
STORED = "zstd"

# Settings that only speed depends on. Set on sessions built here; a cluster's own values win.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "postloom", cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str((os.cpu_count() or 8) if cpus == "*" else cpus))
    )
    for key, value in {**RESULT_CONF, **SPEED_CONF}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on in a session somebody else built."""
    for key, value in RESULT_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for written tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, which every executor of a cluster can reach. Only
    where that setting is missing (local tests) is a machine-local temporary folder used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.conf.get("spark.master", "") or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="postloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of :func:`shared_dir` that no later step reads, on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def move_files(spark: SparkSession, path: str, target: str, prefix: str) -> int:
    """Move a folder's files into another folder of the same file system, made if need be; returns how many.

    Their names get a ``prefix``: files of several folders that one job wrote have the same names.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder, to = hadoop.Path(path), hadoop.Path(target)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(to)
    found = [status.getPath() for status in files.listStatus(folder)] if files.exists(folder) else []
    for file in found:
        if not files.rename(file, hadoop.Path(to, prefix + file.getName())):
            raise OSError(f"{file} was not moved to {target}")
    return len(found)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


SPLIT = "spark.sql.files.maxPartitionBytes"


@contextmanager
def splits_of_at_most(spark: SparkSession, size: int) -> Iterator[None]:
    """Files are read in tasks of at most ``size`` stored bytes; a session that sets less keeps it.

    Streams started within keep the setting. For files that hold far more than their size tells, as
    equal texts side by side do.
    """
    before = spark.conf.get(SPLIT)
    session_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(SPLIT, str(min(max(1, size), session_bytes)))
    try:
        yield
    finally:
        spark.conf.set(SPLIT, before)
