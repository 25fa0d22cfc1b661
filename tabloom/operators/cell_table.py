"""A key/cell table that is written again and again.

Every write is a run: its cells, bucketed and sorted by row key, with a version higher than that of any run before. The
table is the union of its runs, and of a cell the run with the highest version counts. As all runs
share their buckets, wide rows are read without a shuffle however many runs there are.

``compact`` writes what counts as one run, to a table of its own, and then switches over in one step
of the catalog: before it the old runs are read, after it the new one, and a compaction that is
stopped changes nothing.

Of cells that repeat within a write the largest value is kept, null being the least. One writer at a time.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.durable import removed
from tabloom.operators.cells import gathered_wide

_CELL = ("rowkey", "family", "qualifier")


class CellTable:
    """Cells ``(rowkey, family, qualifier, value, version)``, all text but for the version.

    ``name`` is a view over the table of the runs in force; the files lie below ``path``. A table that is
    there already keeps its number of buckets. All cells of a row lie in one bucket.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        if spark.catalog.tableExists(name):
            self.buckets = int(self._property("buckets"))
        else:
            self.buckets = buckets
            self._switch(self._new_runs(), 0)

    def _property(self, key: str) -> str:
        found = self.spark.sql(f"show tblproperties {self.name}").where(F.col("key") == key).first()
        return found["value"]

    def _new_runs(self) -> str:
        """An empty table for runs."""
        part = uuid.uuid4().hex
        runs = f"{self.name}_{part}"
        self.spark.sql(
            f"create table {runs} (rowkey string, family string, qualifier string, value string, version bigint)"
            f" using parquet clustered by (rowkey) sorted by (rowkey) into {self.buckets} buckets"
            f" location '{self.path}/{part}'"
        )
        return runs

    def _switch(self, runs: str, version: int) -> None:
        self.spark.sql(
            f"create or replace view {self.name} tblproperties ('runs' = '{runs}', 'buckets' = '{self.buckets}',"
            f" 'version' = '{version}') as select * from {runs}"
        )

    def _append(self, cells: DataFrame, runs: str) -> None:
        (
            cells.select(*_CELL, "value", "version")
            .repartition(self.buckets, "rowkey")
            .write.format("parquet")
            .mode("append")
            .option("path", f"{self.path}/{runs.rpartition('_')[2]}")
            .bucketBy(self.buckets, "rowkey")
            .sortBy("rowkey")
            .saveAsTable(runs)
        )

    def write(self, cells: DataFrame) -> int:
        """Add a run of cells ``(rowkey, family, qualifier, value)``; returns its version."""
        version = max(int(self._property("version")) + 1, int(time.time() * 1000))
        text = [F.col(c).cast("string").alias(c) for c in (*_CELL, "value")]
        # repeated cells are reduced before the shuffle
        once = cells.select(*text).groupBy(*_CELL).agg(F.max("value").alias("value"))
        self._append(once.withColumn("version", F.lit(version)), self._property("runs"))
        self.spark.sql(f"alter view {self.name} set tblproperties ('version' = '{version}')")
        return version

    def cells(self) -> DataFrame:
        """The cells of all runs."""
        return self.spark.table(self._property("runs"))

    def current(self) -> DataFrame:
        """Each cell once, as last written."""
        latest = F.max(F.struct("version", "value")).alias("latest")
        return self.cells().groupBy(*_CELL).agg(latest).select(*_CELL, "latest.value", "latest.version")

    def wide(self, names: list[str], keep_empty: bool = True) -> DataFrame:
        """A row for each row key with the columns named, see ``cells_to_wide``."""
        return gathered_wide(self.cells(), names, version="version", keep_empty=keep_empty)

    def compact(self) -> None:
        """Make one run of all. The files of the old ones stay for readers under way, until ``clean``."""
        old, new = self._property("runs"), self._new_runs()
        try:
            self._append(self.current(), new)
        except BaseException:
            self.spark.sql(f"drop table if exists {new}")
            raise
        self._switch(new, int(self._property("version")))
        self.spark.sql(f"drop table if exists {old}")

    def clean(self) -> None:
        """Delete the files of runs that are in force no more."""
        context = self.spark.sparkContext
        root = context._jvm.org.apache.hadoop.fs.Path(self.path)
        kept = self._property("runs").rpartition("_")[2]
        for found in root.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(root):
            if found.getPath().getName() != kept:
                removed(self.spark, found.getPath().toString())

    def forget(self) -> None:
        """Drop the names; the files stay at ``path``."""
        runs = self._property("runs")
        self.spark.sql(f"drop view if exists {self.name}")
        self.spark.sql(f"drop table if exists {runs}")
