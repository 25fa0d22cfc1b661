"""Datasets whose partitions are replaced as a whole, by runs that may be stopped and run again.

A run writes its files to a folder of its own, ``_run=<id>``, below the dataset. When all are written it publishes a
manifest, a small file that names a folder for each partition the run wrote. Nothing counts that no
manifest names, so a run that was stopped half-way has written nothing, and readers that are
under way keep the files they began with.

A later manifest replaces an earlier one partition by partition, and within a partition writer by writer: a job
that saves several results to one dataset gives each a name of its own, they add up, and the job run again replaces
what it wrote before. A manifest holds the partitions of its own run alone: publishing takes the time of what is
written, whatever the table holds. Which folders are in force is worked out by Spark from all manifests.

``clean`` deletes the folders that are in force no more.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.projection import rename_to
from tabloom.schema import Field
from tabloom.sinks.width import output_width

_RUN, _MANIFESTS = "_run", "_manifests"
_ENTRY = "number bigint, run string, writer string, partition string, whole boolean, schema string"


class _Folder:
    """The file system a path is on, through the driver's Hadoop client."""

    def __init__(self, spark: SparkSession, path: str):
        self.make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.root = self.make(path)
        self.system = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.make(self.root, name) if name else self.root

    def names(self, name: str = "") -> list[tuple[str, int]]:
        """Names and times of change of what lies in a folder, none if there is no such folder."""
        place = self.at(name)
        if not self.system.exists(place):
            return []
        return sorted((s.getPath().getName(), s.getModificationTime()) for s in self.system.listStatus(place))

    def partitions(self, run: str, depth: int) -> list[str]:
        """The folders ``depth`` levels below a run's that hold a file, by their path below it."""
        found = [""]
        for _ in range(depth):
            found = [f"{f}/{n}".lstrip("/") for f in found for n, _ in self.names(f"{run}/{f}".rstrip("/")) if "=" in n]
        return found

    def put(self, name: str, content: bytes) -> None:
        """A file that is there as a whole or not at all."""
        draft = self.at(f"{_MANIFESTS}/.{uuid.uuid4().hex}.tmp")
        stream = self.system.create(draft, False)
        try:
            stream.write(content)
        finally:
            stream.close()
        if not self.system.rename(draft, self.at(name)):
            self.system.delete(draft, False)
            raise RuntimeError(f"{name} could not be published")

    def delete(self, name: str) -> None:
        self.system.delete(self.at(name), True)


def publish_orc(
    df: DataFrame,
    path: str,
    schema: Iterable[str | Field],
    partition_by: Iterable[str] = (),
    writer: str = "",
    whole: bool = False,
    partitions: int | None = None,
    shuffle: bool = False,
    cast: bool = False,
    gather: bool = False,
) -> list[str]:
    """Write ORC and put it in place of what ``writer`` had in the partitions written; returns these.

    With ``whole`` everything that ``writer`` had goes, also partitions that have no rows any more. The other
    arguments are those of ``write_orc``. A dataset keeps its schema and its partition columns.
    """
    spark = df.sparkSession
    by = list(partition_by)
    schema = list(schema)
    out = rename_to(df, schema, cast)
    fields = [T.StructField(f.name, f.dataType) for f in out.schema.fields]  # nullable, as files are
    kept = json.dumps({"schema": json.loads(T.StructType(fields).json()), "by": by}, sort_keys=True)
    folder = _Folder(spark, path)
    known = folder.names(_MANIFESTS)
    if known and (before := _manifests(spark, path).select("schema").first()) and before["schema"] != kept:
        raise ValueError(f"{path} has another schema or other partitions")
    if gather and by:
        out = out.hint("rebalance", *by)
    run = uuid.uuid4().hex
    home = f"{_RUN}={run}"
    output_width(out, partitions, shuffle).write.partitionBy(*by).orc(f"{path.rstrip('/')}/{home}")
    written = folder.partitions(home, len(by))
    # the number tells later from earlier; of two runs that publish at once the larger run id counts as later
    number = 1 + max((int(name.split("-")[0]) for name, _ in known if not name.startswith(".")), default=0)
    entry = {"number": number, "run": run, "writer": writer, "whole": whole, "schema": kept}
    lines = [json.dumps(entry | {"partition": p}) for p in written] or [json.dumps(entry)]
    folder.put(f"{_MANIFESTS}/{number:019d}-{run}.json", "\n".join(lines).encode())
    return written


def _manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_ENTRY).json(f"{path.rstrip('/')}/{_MANIFESTS}")


def published(spark: SparkSession, path: str) -> DataFrame:
    """(writer, partition, run) of the folders in force."""
    entries = _manifests(spark, path)
    order = F.struct("number", "run")
    cleared = entries.where("whole").groupBy("writer").agg(F.max(order).alias("cleared"))
    named = entries.where("partition is not null").groupBy("writer", "partition").agg(F.max(order).alias("last"))
    # a run that took the place of all clears what is older than itself
    in_force = named.join(F.broadcast(cleared), "writer", "left").where("cleared is null or last >= cleared")
    return in_force.select("writer", "partition", F.col("last.run").alias("run"))


def read_published(spark: SparkSession, path: str, partitions: Column | None = None) -> DataFrame:
    """The rows in force. ``partitions``, a condition on the text ``partition`` ("a=1/b=x"), leaves the others unread."""
    kept = json.loads(_manifests(spark, path).select("schema").first()["schema"])
    schema = T.StructType.fromJson(kept["schema"])
    found = published(spark, path)
    if partitions is not None:
        found = found.where(partitions)
    root = path.rstrip("/")
    folders = [f"{root}/{_RUN}={r['run']}/{r['partition']}".rstrip("/") for r in found.collect()]  # one per partition
    if not folders:
        return spark.createDataFrame([], schema)
    # paths are handed to Hadoop, in which names of partitions are escaped already
    wide = T.StructType([*schema.fields, T.StructField(_RUN, T.StringType())])
    return spark.read.schema(wide).option("basePath", root).orc(folders).select(*(f"`{c}`" for c in schema.names))


def clean(spark: SparkSession, path: str, older_than: float = 86_400) -> list[str]:
    """Delete folders of runs that no manifest in force names and that did not change for so many seconds; returns them.

    The time leaves alone runs under way, and readers that began before the last run was published.
    """
    folder = _Folder(spark, path)
    used = {f"{_RUN}={r['run']}" for r in published(spark, path).select("run").distinct().collect()}
    limit = (time.time() - older_than) * 1000
    gone = [n for n, changed in folder.names() if n.startswith(f"{_RUN}=") and n not in used and changed <= limit]
    for name in gone:
        folder.delete(name)
    return gone

