"""Intermediate results as tables in shared storage.

A lookup is written once, in the pass that works it out, and joined from there: it is not
computed again for every use, its size is known exactly, and a lost executor costs nothing.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SETTING = "spark.checkpoint.dir"

#: The folder of the workspace the caller is in, if any.
_WORKSPACE: ContextVar[str | None] = ContextVar("workspace", default=None)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tabloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    Where it names none this is a folder of the default file system, if executors share that,
    or in local mode a temporary one. The setting is taken at its word, ``file:`` paths
    included: only the cluster's owner knows which folders are mounted everywhere.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING)
    if folder:
        return folder.rstrip("/")
    if context.master.startswith("local"):  # one machine
        return _local_folder()
    if context._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    return f"/tmp/tabloom-{context.sparkUser()}"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used yet, in the workspace the caller is in or else in the shared folder."""
    return f"{_WORKSPACE.get() or shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is stored in the block, deleted at its end.

    What operators return reads the tables they stored, so results are to be written or collected within the block::

        with workspace(spark):
            near_duplicates(documents).write.parquet(path)

    Workspaces may be nested; what is stored in the inner one goes with it.
    """
    path = new_folder(spark, "workspace")
    token = _WORKSPACE.set(path)
    try:
        yield path
    finally:
        _WORKSPACE.reset(token)
        removed(spark, path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder made here, whatever file system it is on."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, purpose: str, under: str | None = None, compression: str | None = None) -> DataFrame:
    """The rows as a table of their own, in the folder ``under`` if one is given."""
    path = f"{under}/{purpose}-{uuid.uuid4().hex}" if under else new_folder(df.sparkSession, purpose)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_with(
    df: DataFrame, purpose: str, under: str | None = None, **metrics: Column
) -> tuple[DataFrame, dict]:
    """The rows as a table, and aggregates over them taken while writing."""
    seen = Observation(purpose)
    table = written(df.observe(seen, *(c.alias(n) for n, c in metrics.items())), purpose, under)
    return table, seen.get
