"""Folders for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_unset_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, else the one set on the context.

    Only a local session that names none (a test) gets a temporary folder; on a
    cluster that would be another folder on every machine, so it is an error.
    """
    global _unset_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    # Spark appends a folder of its own to what was set.
    given = spark.sparkContext.getCheckpointDir()
    if given:
        return given
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _unset_root is None:
        _unset_root = tempfile.mkdtemp(prefix="wharfline-")
    return _unset_root


def new_dir(spark: SparkSession, purpose: str) -> str:
    """Name of a fresh folder below the shared one; nothing is created."""
    return f"{shared_root(spark).rstrip('/')}/wharfline/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` work in sessions that name no folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(spark))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any filesystem Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
