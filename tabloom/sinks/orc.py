"""Partitioned ORC datasets and their catalog entry."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tabloom.operators.projection import rename_to
from tabloom.schema import Field, declare, quoted
from tabloom.sinks.width import output_width


def write_orc(
    df: DataFrame,
    path: str,
    schema: Iterable[str | Field],
    partition_by: Iterable[str] = (),
    mode: str = "errorifexists",
    partitions: int | None = None,
    shuffle: bool = False,
    cast: bool = False,
    gather: bool = False,
) -> None:
    """Name columns after ``schema`` and write ORC below ``path``.

    ``gather`` rebalances rows by the partition columns first: each directory gets few files,
    and adaptive execution splits one that holds much of the data over several tasks.
    """
    partition_by = list(partition_by)
    out = rename_to(df, schema, cast)
    if gather and partition_by:
        out = out.hint("rebalance", *partition_by)
    output_width(out, partitions, shuffle).write.mode(mode).partitionBy(*partition_by).orc(path)


def add_partitions(spark: SparkSession, name: str, partitions: Iterable[dict[str, str]], at_once: int = 500) -> None:
    """Enter partitions just written, as column to text each, in a registered table; those it has stay.

    The time is that of what was written, whatever the table holds.
    """
    text = lambda value: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    named = [", ".join(f"{quoted(c)} = {text(v)}" for c, v in p.items()) for p in partitions]
    for start in range(0, len(named), at_once):
        every = " ".join(f"PARTITION ({p})" for p in named[start : start + at_once])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {every}")


def register_orc_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: Iterable[str | Field],
    partition_by: Iterable[str] = (),
    find: bool = True,
) -> DataFrame:
    """Enter the dataset at ``path`` in the catalog and find its partitions.

    Partition columns are strings. Finding lists the whole dataset; a job that knows what it has written
    registers with ``find=False`` and goes on with ``add_partitions``. Returns the table.
    """
    partition_by = list(partition_by)
    sql_type = {f.name: f.data_type.simpleString() for f in declare(schema)}
    unknown = [p for p in partition_by if p not in sql_type]
    if unknown:
        raise ValueError(f"partition columns not in the schema: {unknown}")
    columns = [f"{quoted(n)} {t}" for n, t in sql_type.items() if n not in partition_by]
    columns += [f"{quoted(p)} string" for p in partition_by]
    by = f" PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING orc{by} LOCATION '{location}'")
    if partition_by and find:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)
