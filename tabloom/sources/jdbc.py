"""Lookup tables read over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tabloom.operators.dimension import Dimension


def read_query(spark: SparkSession, url: str, query: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The rows of ``query``, run by the database.

    ``options`` are those of Spark's JDBC source: user, password, driver, fetchsize, and
    partitionColumn with its bounds and numPartitions to read a large table in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(options or {}))
    return reader.option("dbtable", f"({query.strip().rstrip(';')}) q").load()


#: The text of a query, alone or with options of its own.
Query = str | tuple[str, Mapping[str, str]]


def read_dimensions(
    spark: SparkSession,
    url: str,
    queries: Mapping[str, Query | list[Query]],
    options: Mapping[str, str] | None = None,
    order_by: str | None = None,
) -> dict[str, Dimension]:
    """Alias -> dimension, one map per query.

    The first column of a query is the key and the second the value; ``order_by`` may name a
    further one to choose between rows of the same key. A query may be a pair of its text and
    options that go before the common ones: ``url`` for another database, or
    partitionColumn and its kin to read one large map in parallel. Dicts from several calls
    merge as dicts do, a later alias replacing an earlier one.
    """

    def read(query: Query) -> DataFrame:
        text, own = (query, {}) if isinstance(query, str) else query
        merged = {**(options or {}), **own}
        return read_query(spark, merged.pop("url", url), text, merged)

    def several(query: Query | list[Query]) -> list[Query]:
        return query if isinstance(query, list) else [query]

    return {alias: Dimension(*map(read, several(query)), order_by=order_by) for alias, query in queries.items()}
