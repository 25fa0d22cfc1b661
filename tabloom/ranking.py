"""Exact global row numbers without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.durable import written

#: monotonically_increasing_id() holds the partition above this bit and the row's place below it.
_PLACE_BITS = 33


def numbered(
    df: DataFrame, keys: list[str | Column], rank: str, under: str | None = None, parts: int | None = None
) -> DataFrame:
    """The rows with their number from 0 in the order of ``keys``.

    ``keys`` must tell all rows apart, so that the ranges dealt to tasks can be cut anywhere and
    none grows with a frequent value. Each task numbers its own range and the ranges' row counts
    (one per partition) give the offset of each. The sorted table is written once: the numbers
    survive the loss of an executor. ``df`` should be a stored table, as the ranges are sampled.
    ``parts`` is how many ranges there are, where they are not to follow the session's shuffles.
    """
    place, part, base = "_place", "_part", "_base"
    dealt = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    table = written(
        dealt.sortWithinPartitions(*keys).withColumn(place, F.monotonically_increasing_id()),
        "numbered",
        under,
    )
    of_part = F.shiftright(place, _PLACE_BITS)
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = table.groupBy(of_part.alias(part)).count()
    # one row per partition, stored: what reads the numbers does not gather it again
    bases = written(
        counts.select(part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(base)), "numbered-bases", under
    )
    return (
        table.withColumn(part, of_part)
        .join(F.broadcast(bases), part)
        .withColumn(rank, F.col(base) + F.col(place).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
        .drop(part, base, place)
    )
