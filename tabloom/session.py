"""Session settings for the length of a block."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SPLIT = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The settings as given, and as they were before once the block ends."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def split_hot_keys(spark: SparkSession):
    """Let adaptive execution split a hot key at the price of a further shuffle, in plans run in the block.

    It would otherwise leave one where two joins share a partitioning, as large lookups by the
    same column do. A flow's ``save`` does this by itself.
    """
    return settings(spark, _SPLIT)
