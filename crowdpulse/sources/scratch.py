"""Folders shared by driver and executors, for checkpoints and staged data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names; a local one only on one machine, as in tests."""
    root = spark.conf.get(SETTING, None)
    if root:
        return root
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {SETTING} to a folder that all machines of {master} share")
    return f"{tempfile.gettempdir()}/crowdpulse"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name; writers create it."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str) -> tuple:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(context._jsc.hadoopConfiguration())


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder this package wrote; nothing happens if it is not there."""
    target, files = _file_system(spark, path)
    files.delete(target, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it."""
    target, files = _file_system(spark, path)
    files.create(target, True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    target, files = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match, if any."""
    target, files = _file_system(spark, pattern)
    return [s.getPath().toString() for s in files.globStatus(target) or []]
