"""Partitioned ORC datasets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabloom.schema import Field, struct


# The markers of a job's end, and how names of what is not yet or never data begin and end.
_MARKERS = ("_success", "_fail")
_HIDDEN = ("_", ".")
_UNFINISHED = ".tmp"


def _is_data(path: str) -> bool:
    """Whether a file counts, by its path below the table: what Spark's readers skip does not."""
    *folders, name = path.split("/")
    if name.startswith(".") or name.endswith(_UNFINISHED) or name.lower() in _MARKERS:
        return False
    return not any(part.startswith(_HIDDEN) and "=" not in part for part in [*folders, name])


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a data file at any depth.

    Hidden files, ``.tmp`` files, the ``_success``/``_fail`` markers and whatever lies in a folder
    that Spark skips, as ``_temporary`` of a job under way, do not count. The listing is lazy and
    stops at the first data file.
    """
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(jsc.hadoopConfiguration())
    if not fs.exists(root):
        return False
    base = fs.getFileStatus(root).getPath().toUri().getPath().rstrip("/")
    files = fs.listFiles(root, True)
    while files.hasNext():
        if _is_data(files.next().getPath().toUri().getPath()[len(base) :].lstrip("/")):
            return True
    return False


def empty_table(spark: SparkSession, schema: Iterable[str | Field]) -> DataFrame:
    """No rows, with the declared columns."""
    return spark.createDataFrame([], struct(schema))


def read_partition(
    spark: SparkSession, table: str, partition: str | None = None, source_schema: T.StructType | None = None
) -> DataFrame:
    """The files below ``partition`` of the dataset at ``table``.

    Directories named ``column=value`` between the two become columns. Without a partition
    the whole dataset is read, and filters on those columns prune directories.
    ``source_schema`` spares the footer read that schema inference costs.
    """
    reader = spark.read.option("basePath", table)
    if source_schema is not None:
        reader = reader.schema(source_schema)
    return reader.orc(partition or table)
