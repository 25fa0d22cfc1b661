"""Grouping sets over many dimensions, each worked out from the smallest finer one.

Spark multiplies its input by the number of sets before it groups: a cube of n columns shuffles
2**n rows for each group of the finest set. Here the finest set is grouped once from the table, and
every other set from the stored one with the fewest rows among those with one dimension more. The
sets of a level are one job, so a cube takes n + 1 jobs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.durable import written

_SET, _ROWS = "_set", "_rows"


@dataclass(frozen=True)
class Additive:
    """An aggregate that can be worked out from aggregates of parts."""

    of_rows: Column
    of_parts: str

    def merged(self, name: str) -> Column:
        if self.of_parts == "count":
            return F.coalesce(F.sum(name), F.lit(0)).alias(name)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.of_parts](name).alias(name)


def rows() -> Additive:
    return Additive(F.count(F.lit(1)), "count")


def known(column: Column | str) -> Additive:
    """How many values are not null."""
    return Additive(F.count(column), "count")


def added(column: Column | str) -> Additive:
    return Additive(F.sum(column), "sum")


def lowest(column: Column | str) -> Additive:
    return Additive(F.min(column), "min")


def highest(column: Column | str) -> Additive:
    return Additive(F.max(column), "max")


def cube(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(dimensions), -1, -1) for s in combinations(dimensions, n)]


def rollup(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def grouping_sets(
    df: DataFrame,
    dimensions: Sequence[str],
    sets: Iterable[Sequence[str]],
    aggregates: dict[str, Additive],
    grouping: str = "grouping",
    under: str | None = None,
) -> DataFrame:
    """Dimensions, aggregates and ``grouping`` of every group of every set.

    A dimension that a set leaves out is null, and its bit in ``grouping`` is set, the last dimension's
    being the lowest, as of SQL's ``grouping_id``. A set named twice is there once. The set of no dimension has one
    row, for an empty table too.
    """
    order = list(dimensions)
    wanted = {frozenset(s) for s in sets}
    if unknown := set().union(*wanted) - set(order):
        raise ValueError(f"sets name {sorted(unknown)}, which are no dimensions")
    if clash := {grouping, *order} & set(aggregates):
        raise ValueError(f"columns {sorted(clash)} are taken")
    bits = lambda s: sum(1 << (len(order) - 1 - k) for k, d in enumerate(order) if d not in s)

    def shaped(grouped: DataFrame, s: frozenset[str], source: DataFrame) -> DataFrame:
        """All sets have the same columns."""
        absent = lambda d: F.lit(None).cast(source.schema[d].dataType).alias(d)
        return grouped.select(
            F.lit(bits(s)).cast("bigint").alias(_SET), *(F.col(d) if d in s else absent(d) for d in order), *aggregates
        )

    finest = frozenset().union(*wanted) if wanted else frozenset()
    names = [d for d in order if d in finest]
    first = df.groupBy(*names).agg(*(a.of_rows.alias(n) for n, a in aggregates.items()))
    stored = {finest: written(shaped(first, finest, df), "grouping-set", under)}
    rows_of = {finest: stored[finest].count()}
    parts = [stored[finest]] if finest in wanted else []
    for size in range(len(finest) - 1, -1, -1):
        # a set that is not wanted may still be the way to coarser ones that are
        level = [s for s in map(frozenset, combinations(names, size)) if any(w <= s for w in wanted)]
        found = []
        for s in level:
            parent = min((p for p in stored if s < p and len(p) == size + 1), key=lambda p: rows_of[p])
            merged = [a.merged(n) for n, a in aggregates.items()]
            grouped = stored[parent].groupBy(*(d for d in order if d in s)).agg(*merged)
            found.append(shaped(grouped, s, df))
        if not found:
            continue
        table = written(reduce(DataFrame.unionByName, found), "grouping-level", under)
        counts = {r[_SET]: r["count"] for r in table.groupBy(_SET).count().collect()}  # one for each set
        for s in level:
            stored[s] = table.where(F.col(_SET) == bits(s))
            rows_of[s] = counts.get(bits(s), 0)
        if kept := [bits(s) for s in level if s in wanted]:
            parts.append(table.where(F.col(_SET).isin(kept)))
    answer = reduce(DataFrame.unionByName, parts)
    return answer.select(*order, *aggregates, F.col(_SET).alias(grouping))
