"""What a lookup weighs, measured before anything is broadcast, and how it is joined."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.durable import written_with
from tabloom.functions.expr import Scope

_ROW_OVERHEAD = 32


class Limits(NamedTuple):
    """Bytes up to which a lookup is broadcast, and beyond that its share of a partition hashed.

    ``together`` bounds what the lookups of one stage broadcast in all.
    """

    broadcast: int = 64 * 1024 * 1024
    partition: int = 64 * 1024 * 1024
    together: int = 256 * 1024 * 1024


class Size(NamedTuple):
    rows: int
    bytes: int
    null_keys: int


def _width(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return F.lit(16)


def settled(df: DataFrame, key: str, purpose: str, under: str | None = None) -> tuple[DataFrame, Size]:
    """A lookup written to shared storage, and its size: rows exactly, bytes as an upper estimate."""
    weight = reduce(Column.__add__, (_width(f) for f in df.schema), F.lit(_ROW_OVERHEAD)).cast("bigint")
    table, seen = written_with(
        df,
        purpose,
        under,
        rows=F.count(F.lit(1)),
        bytes=F.coalesce(F.sum(weight), F.lit(0)),
        null_keys=F.count_if(F.col(key).isNull()),
    )
    return table, Size(**seen)


def join_lookup(scope: Scope, key: Column, side: DataFrame, size: Size, limits: Limits) -> None:
    """Left join a lookup (one row per value of its first column) to the scope's frame on ``key``.

    A side measured within the limits is broadcast, while all those of the stage together are. A
    larger one is shuffled, and hashed in each partition while its share there stays within them,
    which spares sorting the table; beyond that the two are merged. Adaptive execution splits the
    partition of a hot key in either case, that of the rows without a key included: the side is
    read from storage, so both inputs of the join are plain shuffles, as this requires. For two
    lookups by one column that takes ``split_hot_keys`` around the run.
    """
    other = F.col(side.columns[0])
    # Without a null key to find, plain equality does: one column to shuffle by, a cheaper hash table.
    equal = key.eqNullSafe(other) if size.null_keys else key == other
    if size.bytes <= min(limits.broadcast, limits.together - scope.broadcast):
        scope.broadcast += size.bytes
        side = F.broadcast(side)
    else:
        partitions = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # keys are unique, so they spread evenly
        side = side.hint("shuffle_hash" if size.bytes / partitions <= limits.partition else "merge")
    scope.frame = scope.frame.join(side, equal, "left")


def at_once(work: Callable[[int], object], n: int) -> list:
    """The results of independent Spark jobs, run at the same time, in the workspace the caller is in."""
    if n == 1:
        return [work(0)]
    contexts = [copy_context() for _ in range(n)]
    with ThreadPoolExecutor(n) as pool:
        return list(pool.map(lambda i: contexts[i].run(work, i), range(n)))
