"""Range lookups: the value of the range a number falls into.

Ranges may overlap and the one with the highest ``(lo, hi)`` wins, so a map is a step
function: a sorted list of starting points, each with the range in force from there on. A
table is looked up by finding the step of its number and joining the value by that range's
start, an equi-join whatever the ranges look like. Values never leave Spark, and a row carries
none but the one it wants.

The top of the search is a binary search among at most ``top_cuts`` numbers (Spark ML's
``Bucketizer``). Where a map has more steps they hang below it as a tree: each node holds
``steps_per_cut`` starting points, and a level is one more equi-join by the node's number. The
lists on the driver and on a row thus stay the same size however large the map is.

The steps of a map of moderate size are worked out in one go from its ``(lo, hi)``. A larger one
is cut into slabs that tasks work on apart: a slab needs the ranges with an end in it and
the best range that spans it. The latter comes from a binary tree over the slabs, where a
range is entered at the few nodes that make up the slabs it spans.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.durable import written
from tabloom.functions.conditions import number_of
from tabloom.functions.expr import Expr, Operand, Scope
from tabloom.operators.dimension import Folder, find, first_found
from tabloom.operators.sizing import Limits, at_once, join_lookup, settled
from tabloom.ranking import numbered

_INF = float("inf")

# Ship the function that walks a slab with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def range_value(df: DataFrame) -> DataFrame:
    """Ranges ``(lo, hi, v)`` from ``(key text "min_max", value)`` or ``(lo, hi, value)`` columns.

    Keys that do not hold two numbers match nothing and are left out. Of the ranges starting
    at one point only the longest can ever win, so one row per start remains.
    """
    if len(df.columns) not in (2, 3):
        raise ValueError(f"a range map has 2 or 3 columns, got {df.columns}")
    if len(df.columns) == 2:
        df = df.toDF("key", "v")
        ends = F.split("key", "_")
        lo, hi = (number_of(F.get(ends, F.lit(i))) for i in (0, 1))
        df = df.select(lo.alias("lo"), hi.alias("hi"), "v")
    else:
        df = df.toDF("lo", "hi", "v").select(F.col("lo").cast("double"), F.col("hi").cast("double"), "v")
    usable = ~F.isnan("lo") & ~F.isnan("hi") & (F.col("lo") <= F.col("hi"))
    longest = F.max(F.struct("hi", "v")).alias("b")
    return df.where(usable).groupBy("lo").agg(longest).select("lo", "b.hi", "b.v")


def steps_of(lo: np.ndarray, hi: np.ndarray, start: float, end: float) -> tuple[list[float], list[float]]:
    """Starting points in ``[start, end)`` and the ``lo`` in force from each on (NaN for none).

    Walks the ranges by ``lo``, keeping those still open on a stack. A newer range hides the
    older ones for as long as it lasts, so an older one stays only if it ends later.
    """
    points, winners = [start], [np.nan]

    def put(point: float, winner: float) -> None:
        if point >= end:
            return
        if points[-1] == point:
            winners[-1] = winner
        else:
            points.append(point)
            winners.append(winner)

    open_ranges: list[tuple[float, float]] = []

    def close_before(point: float) -> None:
        while open_ranges and open_ranges[-1][1] < point:
            _, closed = open_ranges.pop()
            put(math.nextafter(closed, _INF), open_ranges[-1][0] if open_ranges else np.nan)

    for i in np.argsort(lo, kind="stable"):
        low, high = float(lo[i]), float(hi[i])
        close_before(low)
        while open_ranges and open_ranges[-1][1] <= high:
            open_ranges.pop()
        open_ranges.append((low, high))
        put(max(low, start), low)
    close_before(end)
    return points, winners


def _position(df: DataFrame, cuts: list[float], number: str, out: str) -> DataFrame:
    """Add the index of the cut interval ``number`` lies in; below the first cut it is 0."""
    bucketizer = Bucketizer(splits=[-_INF, *cuts, _INF], inputCol=number, outputCol=out, handleInvalid="keep")
    # the cast also drops the column's metadata, a description of every interval
    return bucketizer.transform(df).withColumn(out, F.col(out).cast("int"))


def _tree_nodes(first: Column, last: Column, levels: int) -> Column:
    """Tree nodes that together make up the slabs ``first`` .. ``last - 1``, as (level, node)."""

    def at(level: Column) -> Column:
        size = F.pow(F.lit(2.0), level)
        low, high = F.ceil(first / size), F.floor(last / size)
        both = F.array(
            F.when((low < high) & (low % 2 == 1), low),
            F.when((low < high) & (high % 2 == 1), high - 1),
        )
        return F.transform(F.array_compact(both), lambda n: F.struct(level.alias("level"), n.alias("node")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))


def _literal_array(numbers: np.ndarray) -> Column:
    """Numbers as one constant, folded while planning."""
    return F.split(F.lit(",".join(repr(float(n)) for n in numbers)), ",").cast("array<double>")


class _Index:
    """A map prepared for lookups: the cuts on top, the tree's levels below, and values by range start."""

    def __init__(self, ranges: DataFrame, dimension: RangeDimension):
        self.limits = dimension.limits
        self.fan = dimension.steps_per_cut
        self.folder = dimension.folder.path(ranges.sparkSession)
        ranges, self.size = settled(ranges, "lo", "ranges", self.folder)
        self.values = ranges.select("lo", "v")
        self.levels: list = []
        self.winners: np.ndarray | None = None
        if self.size.rows <= dimension.local_rows:
            ends = ranges.select("lo", "hi").toArrow()
            lo, hi = (ends[c].to_numpy() for c in ("lo", "hi"))
            points, winners = (np.array(x, float) for x in steps_of(lo, hi, -_INF, _INF))
            if len(points) <= dimension.top_cuts:
                self._top(points, winners)
                return
            rank = pa.array(np.arange(len(points)))
            known = pa.array(winners, mask=np.isnan(winners))
            table = pa.table({"start": points, "lo": known, "rank": rank})
            steps, count = ranges.sparkSession.createDataFrame(table), len(points)
        else:
            slabs = min(dimension.max_slabs, max(2, math.ceil(2 * self.size.rows / dimension.slab_rows)))
            steps = written(_steps_by_slab(ranges, slabs), "range-steps", self.folder)
            count = steps.count()
            if count <= dimension.top_cuts:
                known = steps.orderBy("start").toArrow()
                self._top(*(known[c].to_numpy() for c in ("start", "lo")))
                return
            steps = numbered(steps, ["start"], "rank", self.folder)
        self._grow(steps, count, dimension.top_cuts)

    def _top(self, points: np.ndarray, winners: np.ndarray) -> None:
        """No tree is needed: every step is a cut, and NaN, which no range starts at, says that none is in force."""
        self.cuts, self.winners = points[1:].tolist(), winners

    def _grow(self, steps: DataFrame, count: int, top_cuts: int) -> None:
        """The tree's levels, leaves first: a node's number is its place in the level."""
        entry = F.struct("start", "lo")
        while count > top_cuts:
            nodes = steps.groupBy(F.floor(F.col("rank") / self.fan).alias("node")).agg(
                F.sort_array(F.collect_list(entry)).alias("steps")  # self.fan at most
            )
            table, size = settled(nodes, "node", "range-level", self.folder)
            self.levels.append((table, size))
            count = math.ceil(count / self.fan)
            steps = table.select(F.col("node").alias("rank"), F.col("steps")[0]["start"].alias("start"))
            entry = F.struct("start")
        firsts = steps.orderBy("rank").select("start").toArrow()["start"].to_pylist()  # top_cuts at most
        self.cuts = firsts[1:]

    def lookup(self, scope: Scope, number: Column) -> Column:
        x, position = scope.helper(), scope.helper()
        known = F.when(~F.isnan(number), number + F.lit(0.0))
        # without cuts there is one step or node, and any number will do to tell it
        scope.frame = _position(scope.frame.withColumn(x, known), self.cuts or [0.0], x, position)
        at = F.col(position) if self.cuts else F.when(F.col(x).isNotNull(), F.lit(0))
        if self.winners is not None:
            start = F.when(F.col(x).isNotNull(), F.get(_literal_array(self.winners), at.cast("int")))
        for depth, (table, size) in enumerate(reversed(self.levels), 1):
            node, steps = scope.helper(), scope.helper()
            join_lookup(scope, at.cast("bigint"), table.toDF(node, steps), size, self.limits)
            passed = F.filter(F.col(steps), lambda s: s["start"] <= F.col(x))
            if depth == len(self.levels):
                start = F.try_element_at(passed, F.lit(-1)).getField("lo")
            else:
                at = F.col(node) * F.lit(self.fan) + F.size(passed) - F.lit(1)
        lo, v = scope.helper(), scope.helper()
        join_lookup(scope, start, self.values.toDF(lo, v), self.size, self.limits)
        return F.col(v)


def _steps_by_slab(ranges: DataFrame, slabs: int) -> DataFrame:
    """(start, lo) of all steps, lo null where no range is in force."""
    spark = ranges.sparkSession
    ends = ranges.select(F.explode(F.array("lo", "hi")).alias("p")).where(F.abs("p") < _INF)
    by_range = ends.distinct().repartitionByRange(slabs, "p").groupBy(F.spark_partition_id().alias("part"))
    cuts = sorted(r.p for r in by_range.agg(F.min("p").alias("p")).collect())  # one per slab
    levels = len(cuts).bit_length()

    at = _position(_position(ranges.select("lo", "hi"), cuts, "lo", "a"), cuts, "hi", "b")
    starting = at.select(F.col("a").alias("slab"), "lo", "hi")
    # ranges that come in from the left and end together differ only in where they start
    ending = at.where("b > a").groupBy(F.col("b").alias("slab"), "hi").agg(F.max("lo").alias("lo"))
    nodes = (
        at.where("b > a + 1")
        .select("lo", "hi", F.explode(_tree_nodes(F.col("a") + 1, F.col("b"), levels)).alias("n"))
        .groupBy("n.level", "n.node")
        .agg(F.max(F.struct("lo", "hi")).alias("best"))
    )
    all_slabs = spark.range(len(cuts) + 1).select(F.col("id").cast("int").alias("slab"))
    spanning = (
        all_slabs.select("slab", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"))
        .withColumn("node", F.floor(F.col("slab") / F.pow(F.lit(2.0), F.col("level"))))
        .join(nodes, ["level", "node"])
        .groupBy("slab")
        .agg(F.max("best").alias("best"))
        .select("slab", "best.lo", "best.hi")
    )
    none = F.lit(None).cast("double")
    # one row for each slab, so that also a slab without ranges says that nothing is in force
    blank = all_slabs.select("slab", none.alias("lo"), none.alias("hi"))
    parts = starting.unionByName(ending).unionByName(spanning).unionByName(blank)
    borders = [-_INF, *cuts, _INF]

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        slab = int(rows.slab.iloc[0])
        known = rows.dropna(subset=["lo"])
        points, winners = steps_of(
            known.lo.to_numpy(float), known.hi.to_numpy(float), borders[slab], borders[slab + 1]
        )
        return pd.DataFrame({"start": points, "lo": pd.Series(winners).astype(object).where(~np.isnan(winners), None)})

    return parts.groupBy("slab").applyInPandas(walk, "start double, lo double")


class RangeDimension:
    """Range maps under one alias; the i-th number of a lookup is searched in the i-th map.

    ``local_rows`` bounds the maps whose steps are worked out in one go; ``slab_rows`` is the number of
    ends in a slab of a larger one, and more once there are ``max_slabs`` slabs. At most ``top_cuts`` numbers are
    searched on top, and ``steps_per_cut`` at a node of the tree below.
    """

    def __init__(
        self,
        *maps: DataFrame,
        limits: Limits = Limits(),
        local_rows: int = 100_000,
        slab_rows: int = 50_000,
        max_slabs: int = 4_096,
        steps_per_cut: int = 32,
        top_cuts: int = 16_384,
    ):
        if not maps:
            raise ValueError("a range dimension needs at least one map")
        if steps_per_cut < 2:
            raise ValueError("a node of the tree has two steps at least")
        self.maps = [range_value(m) for m in maps]
        self.limits = limits
        self.local_rows = local_rows
        self.slab_rows = slab_rows
        self.max_slabs = max_slabs
        self.steps_per_cut = steps_per_cut
        self.top_cuts = top_cuts
        self.folder = Folder()
        self._indexes: dict[int, _Index] = {}

    def indexes(self, n: int) -> list[_Index]:
        """The first ``n`` maps prepared; worked out at their first use."""
        self.folder.path(self.maps[0].sparkSession)

        def one(i: int) -> _Index:
            if i not in self._indexes:
                self._indexes[i] = _Index(self.maps[i], self)
            return self._indexes[i]

        return at_once(one, n)

    def release(self) -> None:
        """Delete the stored tables; plans that look up in them can no longer run."""
        self._indexes.clear()
        self.folder.remove()


def in_range(alias: str | RangeDimension, *numbers: Operand) -> Expr:
    """Value of the first number that falls into a range, both ends included; else null.

    Numbers may be text. A null, or text that is no number, falls into no range.
    """

    def build(scope: Scope) -> Column:
        found = find(scope, alias, RangeDimension, len(numbers))
        values = []
        for operand, index in zip(numbers, found.indexes(len(numbers))):
            column, data_type = scope.single(operand)
            number = number_of(column) if isinstance(data_type, T.StringType) else column.cast("double")
            values.append(index.lookup(scope, number))
        return first_found(scope, values)

    return Expr(build)
