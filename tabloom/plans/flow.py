"""A job: sources, named tables, results and one save, as a single lazy plan."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabloom.functions.expr import Operand
from tabloom.operators.dimension import Dimension
from tabloom.operators.projection import project
from tabloom.operators.ranges import RangeDimension
from tabloom.operators.stage import stages
from tabloom.plans.select import generated_select
from tabloom.schema import Field, quoted
from tabloom.session import settings, split_hot_keys
from tabloom.sources.partitions import empty_table, has_data, read_partition


class Flow:
    """Steps run in the order they are called; each returns the flow itself.

    Tables become temporary views of the session, so later SQL sees them by name. Nothing is
    cached unless asked for with ``persist=True``, which pays off only for a table that
    several results read.

    The session's settings stay as they are. What the flow runs itself (``save``, ``preview``,
    and the lookups it prepares) runs under its own: hot keys of joins are split, and shuffles have
    ``shuffle_partitions`` if given. ``with flow.settings():`` does the same for other runs of its tables.
    ``close``, or a ``with`` block around the flow, releases what it holds: cached tables and stored lookups.
    """

    def __init__(self, spark: SparkSession, shuffle_partitions: int | None = None):
        self.spark = spark
        self.dimensions: dict[str, Dimension | RangeDimension] = {}
        self.outputs: list[DataFrame] = []
        self.shuffle_partitions = shuffle_partitions
        self._held: list[DataFrame] = []
        self._lookups: list[Dimension | RangeDimension] = []

    @contextmanager
    def settings(self) -> Iterator[None]:
        """The flow's settings, for what runs in the block."""
        width = {}
        if self.shuffle_partitions is not None:
            width["spark.sql.shuffle.partitions"] = str(self.shuffle_partitions)
        with split_hot_keys(self.spark), settings(self.spark, width):
            yield

    def close(self) -> None:
        """Release cached tables and delete stored lookups; the flow's tables can no longer run."""
        for df in self._held:
            df.unpersist()
        for lookup in self._lookups:
            lookup.release()
        self._held, self._lookups = [], []

    def __enter__(self) -> Flow:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def dimension(self, alias: str, lookup: Dimension | RangeDimension) -> Flow:
        """Make a lookup known to the stages of later sources; a later one replaces it."""
        self.dimensions[alias] = lookup
        self._lookups.append(lookup)
        return self

    def _register(self, name: str, df: DataFrame, persist: bool) -> None:
        if persist:
            self._held.append(df.persist())
        df.createOrReplaceTempView(name)

    def source(
        self,
        name: str,
        df: DataFrame,
        steps: Iterable[Mapping[str, Operand]] = (),
        schema: Iterable[str | Field] | None = None,
        persist: bool = False,
        missing_as_null: bool = False,
    ) -> Flow:
        """Reshape ``df`` by the stages, shape it to the schema and name it."""
        with self.settings():
            shaped = stages(df, list(steps), self.dimensions, missing_as_null)
        self._register(name, shaped if schema is None else project(shaped, schema), persist)
        return self

    def partition_source(
        self,
        name: str,
        table: str,
        partition: str,
        schema: Iterable[str | Field],
        steps: Iterable[Mapping[str, Operand]] = (),
        source_schema: StructType | None = None,
        persist: bool = False,
        missing_as_null: bool = False,
    ) -> Flow:
        """A partition of an ORC dataset; without data an empty table of the schema.

        The stages are skipped for an empty table: the columns they read are not known.
        """
        if not has_data(self.spark, partition):
            self._register(name, empty_table(self.spark, schema), persist)
            return self
        scan = read_partition(self.spark, table, partition, source_schema)
        return self.source(name, scan, steps, schema, persist, missing_as_null)

    def table(self, name: str, statement: str, partition_by: str | None = None, persist: bool = False) -> Flow:
        """Name an intermediate result, optionally hash-partitioned by a column.

        The partitioning is a rebalance: rows of a key go together, but a key that holds much
        of the data is split over several tasks instead of making one straggle. It goes by a
        hash of the key, so that Spark does not count on it: a later grouping by the key
        combines rows where they are before it shuffles what little is left.
        """
        df = self.spark.sql(statement)
        if partition_by is not None:
            place = "__place"
            df = df.withColumn(place, F.xxhash64(quoted(partition_by))).hint("rebalance", place).drop(place)
        self._register(name, df, persist)
        return self

    def preview(self, statement: str, rows: int = 20, show: bool = True) -> DataFrame:
        """The first rows of a statement; nothing is saved."""
        df = self.spark.sql(statement).limit(rows)
        if show:
            with self.settings():
                df.show(rows)
        return df

    def result(self, statement: str) -> Flow:
        """Add the result of a statement to what is saved."""
        self.outputs.append(self.spark.sql(statement))
        return self

    def result_select(
        self, schema: Iterable[str | Field], select: Mapping[str, str], source: str, where: str | None = None
    ) -> Flow:
        """Add a result whose SELECT list follows the save schema."""
        self.outputs.append(generated_select(self.spark, schema, select, source, where))
        return self

    def union(self) -> DataFrame:
        """All results one after the other, columns matched by position."""
        if not self.outputs:
            raise ValueError("the flow has no results")
        return reduce(DataFrame.union, self.outputs)

    def save(self, write: Callable[[DataFrame], None], union: bool = False) -> None:
        """Write every result, or their union once. Several results need an appending writer."""
        if not self.outputs:
            raise ValueError("the flow has no results")
        with self.settings():
            for df in [self.union()] if union else self.outputs:
                write(df)
