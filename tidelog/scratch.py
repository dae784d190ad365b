"""Where written intermediate tables and checkpoints go."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for all executors; a temporary one in local mode."""
    named = spark.conf.get(SETTING, None)
    if named is not None:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidelog-")


def scratch(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/tidelog-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``checkpoint()`` usable without replacing a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
