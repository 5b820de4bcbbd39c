"""Folders for data a job writes on the way: streaming checkpoints, open events, derived inputs."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="logtables-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; in local mode a temporary one if that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_folder()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nothing was written to yet."""
    return f"{shared_folder(spark)}/logtables/{name}-{uuid.uuid4().hex}"
