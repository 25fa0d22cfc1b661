"""Window functions over a key that holds most of the table, or over no key at all.

Spark gives all rows of a window's key to one task. Here the rows are put into one global order,
by the key and then by the order within it, and cut into slabs of a fixed number of rows, so that
a key may run through any number of slabs. Window functions then run on a slab's own rows of a key, and
what a slab needs to know of those before and after it comes in one of two ways:

* running values, ranks and first or last values are corrected by what is carried in: a slab's first
  and last key are the only ones that cross its borders, so two rows say all there is to know of a slab, and
  the table of these rows, two for each slab, is worked through in order once;
* lag, lead and sliding frames see the last rows of the slab before and the first rows of the slab behind,
  as many as they reach, and a slab has at least that many rows.

A slab has ``slab_rows`` rows, or a ``max_slabs``-th of the table where that is more, whatever the keys are: no
task gets more rows for a key than that. The table is shuffled twice, once by range and once by slab, into as many
tasks as its rows ask for: tasks do not grow with the table, and what is summed up of a slab is read from its
first and last rows.

Frames are of rows. Nulls come first in ascending and last in descending order, as in Spark. Null
keys are a key. Rows that are equal in key and order are numbered in an order of their own, which
is the same for all functions of one call. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.durable import written
from tabloom.ranking import numbered

_NUMBER, _ROW, _SLAB, _HALO, _SIDE, _GROUP, _KEY, _EDGE = (
    f"_across_{n}" for n in ("number", "row", "slab", "halo", "side", "group", "key", "edge")
)


@dataclass
class _Windows:
    """The windows of a call: over a slab's own rows of a key, by rows or by equal orders, and with the neighbours."""

    keys: list[str]
    order: list[Column]
    values: list[str]

    def __post_init__(self):
        own = Window.partitionBy(_SLAB, *self.keys, _HALO)
        self.rows = own.orderBy(_NUMBER)
        self.until_here = self.rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.whole = self.rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        self.ties = own.orderBy(*self.order)
        self.neighbours = Window.partitionBy(_SLAB, *self.keys).orderBy(_NUMBER)
        # of the small table: the chunks of a key that runs through several slabs
        self.chunks = Window.partitionBy(_GROUP).orderBy(_SLAB, _SIDE)
        self.before = self.chunks.rowsBetween(Window.unboundedPreceding, -1)
        self.upto = self.chunks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.all = self.chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def tie(self) -> Column:
        return F.struct(*self.values)


class Across:
    """One window function. Names of helper columns start with ``n``."""

    #: how many rows before and behind a row are seen
    reach = (0, 0)

    def local(self, n: str, w: _Windows) -> dict[str, Column]:
        """Columns worked out within a slab."""
        raise NotImplementedError

    def summary(self, n: str, w: _Windows) -> dict[str, Column]:
        """Aggregates over the first and the last of the rows that a slab has of its first or last key."""
        return {}

    def carried(self, chunks: DataFrame, n: str, w: _Windows) -> DataFrame:
        """Add to the small table the columns ``{n}_in...`` that correct a chunk's rows."""
        return chunks

    def value(self, n: str) -> Column:
        return F.col(f"{n}_v")


def _continues(chunks: DataFrame, n: str, w: _Windows) -> DataFrame:
    """Whether the chunk's first rows are equal to the last of the chunk before."""
    same = F.lag(f"{n}_last").over(w.chunks).eqNullSafe(F.col(f"{n}_first")) & F.lag(F.lit(True)).over(w.chunks)
    return chunks.withColumn(f"{n}_on", F.coalesce(same, F.lit(False)))


def _tie_ends(n: str, w: _Windows) -> dict[str, Column]:
    return {f"{n}_first": F.min_by(w.tie(), _NUMBER), f"{n}_last": F.max_by(w.tie(), _NUMBER)}


class _RowNumber(Across):
    def local(self, n, w):
        return {f"{n}_v": F.row_number().over(w.rows).cast("bigint")}

    def summary(self, n, w):
        return {f"{n}_n": F.max(_NUMBER) - F.min(_NUMBER) + 1}

    def carried(self, chunks, n, w):
        return chunks.withColumn(f"{n}_in", F.sum(f"{n}_n").over(w.before))

    def value(self, n):
        return F.col(f"{n}_v") + F.coalesce(f"{n}_in", F.lit(0))


class _Rank(_RowNumber):
    """Rows equal to the last ones of the slab before have their rank."""

    def local(self, n, w):
        return {f"{n}_v": F.rank().over(w.ties).cast("bigint")}

    def summary(self, n, w):
        return super().summary(n, w) | {f"{n}_top": F.max(f"{n}_v")} | _tie_ends(n, w)

    def carried(self, chunks, n, w):
        chunks = _continues(super().carried(chunks, n, w), n, w)
        goes_through = F.col(f"{n}_on") & (F.col(f"{n}_top") == 1)
        last_rank = F.when(~goes_through, F.col(f"{n}_top") + F.coalesce(f"{n}_in", F.lit(0)))
        chunks = chunks.withColumn(f"{n}_rank", last_rank)
        before = F.last(f"{n}_rank", ignorenulls=True).over(w.before)
        return chunks.withColumn(f"{n}_in_tie", F.when(F.col(f"{n}_on"), before))

    def value(self, n):
        tied = F.col(f"{n}_in_tie").isNotNull() & (F.col(f"{n}_v") == 1)
        return F.when(tied, F.col(f"{n}_in_tie")).otherwise(super().value(n))


class _DenseRank(Across):
    def local(self, n, w):
        return {f"{n}_v": F.dense_rank().over(w.ties).cast("bigint")}

    def summary(self, n, w):
        return {f"{n}_n": F.max(f"{n}_v")} | _tie_ends(n, w)

    def carried(self, chunks, n, w):
        chunks = _continues(chunks, n, w)
        shared = F.sum(F.col(f"{n}_on").cast("bigint")).over(w.upto)
        return chunks.withColumn(f"{n}_in", F.coalesce(F.sum(f"{n}_n").over(w.before), F.lit(0)) - shared)

    def value(self, n):
        return F.col(f"{n}_v") + F.coalesce(f"{n}_in", F.lit(0))


@dataclass
class _Ntile(_RowNumber):
    """Parts that differ by one row at most, the larger ones first."""

    parts: int

    def local(self, n, w):
        return super().local(n, w) | {f"{n}_all": F.count(F.lit(1)).over(w.whole)}

    def carried(self, chunks, n, w):
        return super().carried(chunks, n, w).withColumn(f"{n}_in_all", F.sum(f"{n}_n").over(w.all))

    def value(self, n):
        place = super().value(n) - 1
        total, parts = F.coalesce(f"{n}_in_all", f"{n}_all"), F.lit(self.parts)
        more = total % parts
        small = F.floor(total / parts)
        head = more * (small + 1)
        behind = more + F.floor((place - head) / F.greatest(small, F.lit(1)))
        return F.when(place < head, F.floor(place / (small + 1))).otherwise(behind) + 1


@dataclass
class _Running(Across):
    """An aggregate over all rows up to this one."""

    column: Column
    here: Callable[[Column], Column]
    over_chunks: Callable[[Column], Column]
    joined: Callable[[Column, Column], Column]

    def local(self, n, w):
        return {f"{n}_v": self.here(self.column).over(w.until_here)}

    def summary(self, n, w):
        return {f"{n}_n": F.max_by(f"{n}_v", _NUMBER)}

    def carried(self, chunks, n, w):
        return chunks.withColumn(f"{n}_in", self.over_chunks(F.col(f"{n}_n")).over(w.before))

    def value(self, n):
        own, carried = F.col(f"{n}_v"), F.col(f"{n}_in")
        return F.coalesce(self.joined(own, carried), own, carried)


@dataclass
class _First(Across):
    """The first value up to this row, or the first that is not null."""

    column: Column
    ignore_nulls: bool

    def _wrapped(self) -> Column:
        value = F.struct(self.column.alias("v"))
        return F.when(self.column.isNotNull(), value) if self.ignore_nulls else value

    def local(self, n, w):
        return {f"{n}_v": F.first(self._wrapped(), ignorenulls=True).over(w.until_here)}

    def summary(self, n, w):
        return {f"{n}_n": F.max_by(f"{n}_v", _NUMBER)}

    def carried(self, chunks, n, w):
        return chunks.withColumn(f"{n}_in", F.first(f"{n}_n", ignorenulls=True).over(w.before))

    def value(self, n):
        return F.coalesce(f"{n}_in", f"{n}_v")["v"]


class _Latest(_First):
    """The last value up to this row that is not null."""

    def local(self, n, w):
        return {f"{n}_v": F.last(self._wrapped(), ignorenulls=True).over(w.until_here)}

    def carried(self, chunks, n, w):
        return chunks.withColumn(f"{n}_in", F.last(f"{n}_n", ignorenulls=True).over(w.before))

    def value(self, n):
        return F.coalesce(f"{n}_v", f"{n}_in")["v"]


class _Closing(_Latest):
    """The last value of all the key's rows."""

    def local(self, n, w):
        return {f"{n}_v": F.last(self._wrapped(), ignorenulls=True).over(w.whole)}

    def carried(self, chunks, n, w):
        return chunks.withColumn(f"{n}_in", F.last(f"{n}_n", ignorenulls=True).over(w.all))

    def value(self, n):
        return F.coalesce(f"{n}_in", f"{n}_v")["v"]


@dataclass
class _Near(Across):
    """A function of a row and its neighbours."""

    function: Callable[[_Windows], Column]
    reach: tuple[int, int] = field(default=(0, 0))

    def local(self, n, w):
        return {f"{n}_v": self.function(w)}


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def row_number() -> Across:
    return _RowNumber()


def rank() -> Across:
    return _Rank()


def dense_rank() -> Across:
    return _DenseRank()


def ntile(parts: int) -> Across:
    if parts < 1:
        raise ValueError("ntile needs one part at least")
    return _Ntile(parts)


def lag(column: Column | str, offset: int = 1, default=None) -> Across:
    """The value ``offset`` rows before, or ``default`` where the key has no such row."""
    if offset < 0:
        return lead(column, -offset, default)
    return _Near(lambda w: F.lag(_column(column), offset, default).over(w.neighbours), (offset, 0))


def lead(column: Column | str, offset: int = 1, default=None) -> Across:
    if offset < 0:
        return lag(column, -offset, default)
    return _Near(lambda w: F.lead(_column(column), offset, default).over(w.neighbours), (0, offset))


def first_value(column: Column | str, ignore_nulls: bool = False) -> Across:
    """The key's first value; with ``ignore_nulls`` the first up to this row that is not null."""
    return _First(_column(column), ignore_nulls)


def latest_value(column: Column | str) -> Across:
    """The last value up to this row that is not null."""
    return _Latest(_column(column), True)


def closing_value(column: Column | str, ignore_nulls: bool = False) -> Across:
    """The last value of all rows of the key."""
    return _Closing(_column(column), ignore_nulls)


def running_sum(column: Column | str) -> Across:
    """The sum up to this row. (Floating-point values are added slab by slab; whole numbers and decimals are exact.)"""
    return _Running(_column(column), F.sum, F.sum, lambda a, b: a + b)


def running_count(column: Column | str) -> Across:
    return _Running(_column(column), F.count, F.sum, lambda a, b: a + b)


def running_min(column: Column | str) -> Across:
    return _Running(_column(column), F.min, F.min, F.least)


def running_max(column: Column | str) -> Across:
    return _Running(_column(column), F.max, F.max, F.greatest)


def sliding(aggregate: Column, preceding: int, following: int = 0) -> Across:
    """An aggregate, such as ``F.sum("x")``, from ``preceding`` rows before this one to ``following`` behind it."""
    if preceding < 0 or following < 0:
        raise ValueError("a sliding frame holds its own row")
    frame = lambda w: aggregate.over(w.neighbours.rowsBetween(-preceding, following))
    return _Near(frame, (preceding, following))


def across(
    df: DataFrame,
    order_by: Sequence[str],
    functions: dict[str, Across],
    partition_by: Sequence[str] = (),
    descending: Sequence[str] = (),
    slab_rows: int = 100_000,
    max_slabs: int = 65_536,
    under: str | None = None,
) -> DataFrame:
    """Add the window functions over ``partition_by`` in the order of ``order_by``, those in ``descending`` downwards.

    Intermediate tables go to the shared folder, or to the folder ``under``.
    """
    clash = [c for c in df.columns if c.startswith("_across_")] + [c for c in functions if c in df.columns]
    if clash:
        raise ValueError(f"columns {clash} are taken")
    keys, values = list(partition_by), list(order_by)
    order = [F.desc(c) if c in descending else F.asc(c) for c in values]
    w = _Windows(keys, order, values)
    named = {f"_across_{i}": f for i, f in enumerate(functions.values())}

    with_row = df.withColumn(_ROW, F.monotonically_increasing_id())
    back, ahead = (max(f.reach[side] for f in functions.values()) for side in (0, 1))
    count = df.count()
    size = max(slab_rows, -(-count // max_slabs), back, ahead, 1)
    parts = max(1, -(-count // (2 * size)))
    ordered = numbered(with_row, [*map(F.asc, keys), *order, F.asc(_ROW)], _NUMBER, under, parts)
    place, slab = F.col(_NUMBER) % size, F.floor(F.col(_NUMBER) / size)
    target = lambda slab, halo: F.struct(slab.alias("slab"), F.lit(halo).alias("halo"))
    seen_from = [target(slab, False)]
    if back:
        seen_from.append(F.when(place >= size - back, target(slab + 1, True)))
    if ahead:
        seen_from.append(F.when((place < ahead) & (slab > 0), target(slab - 1, True)))
    if len(seen_from) == 1:
        rows = ordered.withColumns({_SLAB: slab, _HALO: F.lit(False)})
    else:
        targets = F.explode(F.array_compact(F.array(*seen_from)))
        rows = ordered.withColumn("_across_at", targets)
        rows = rows.withColumns({_SLAB: F.col("_across_at.slab"), _HALO: F.col("_across_at.halo")}).drop("_across_at")
    columns = {name: c for n, f in named.items() for name, c in f.local(n, w).items()}
    summaries = {name: c for n, f in named.items() for name, c in f.summary(n, w).items()}
    if summaries and keys:
        columns[_EDGE] = F.lag(F.lit(True)).over(w.rows).isNull() | F.lead(F.lit(True)).over(w.rows).isNull()
    # a task for each slab, which adaptive execution does not gather
    local = rows.repartition(max(2, -(-count // size)), _SLAB).withColumns(columns).where(~F.col(_HALO))

    if summaries:
        local = written(local, "across-slabs", under)
        local, chunks = _chunks(local, keys, size, summaries, under)
        for n, f in named.items():
            chunks = f.carried(chunks, n, w)
        carried = [c for c in chunks.columns if "_in" in c and c.startswith("_across_")]
        # two rows for each of at most ``max_slabs`` slabs, or fewer
        carried_in = written(chunks.select(_SLAB, _SIDE, *carried), "across-carried", under)
        local = local.join(F.broadcast(carried_in), [_SLAB, _SIDE], "left")
    values_ = [f.value(n).alias(name) for (n, f), name in zip(named.items(), functions, strict=True)]
    return local.select(*df.columns, *values_)


def _chunks(
    local: DataFrame, keys: list[str], size: int, summaries: dict[str, Column], under: str | None
) -> tuple[DataFrame, DataFrame]:
    """The rows with the side of their slab that their key is at, and a summary of each slab's first and last key.

    Chunks of a key that follow each other have the same number in ``_GROUP``.
    """
    last = local.agg(F.max(_NUMBER)).first()[0]
    place = F.col(_NUMBER) % size
    border = (place == 0) | (place == size - 1) | (F.col(_NUMBER) == F.lit(last))
    if keys:
        key = F.struct(*keys)
        of_slab = local.where(border).groupBy(_SLAB)
        ends = of_slab.agg(F.min_by(key, _NUMBER).alias("_a"), F.max_by(key, _NUMBER).alias("_b"))
        side = F.when(key.eqNullSafe(F.col("_a")), F.lit(0)).when(key.eqNullSafe(F.col("_b")), F.lit(1))
        ends = written(ends, "across-ends", under)
        local = local.join(F.broadcast(ends), _SLAB).withColumn(_SIDE, side).drop("_a", "_b")
        edges = local.where(F.col(_EDGE) & F.col(_SIDE).isNotNull())
    else:
        key = F.lit(0)
        local = local.withColumn(_SIDE, F.lit(0))
        edges = local.where(border)
    chunks = written(
        edges.groupBy(_SLAB, _SIDE).agg(F.min_by(key, _NUMBER).alias(_KEY), *(c.alias(n) for n, c in summaries.items())),
        "across-chunks",
        under,
    )
    in_order = Window.orderBy(_SLAB, _SIDE)
    new = ~F.lag(_KEY).over(in_order).eqNullSafe(F.col(_KEY)) | F.lag(F.lit(True)).over(in_order).isNull()
    chunks = chunks.withColumn("_new", new.cast("int"))
    return local, chunks.withColumn(_GROUP, F.sum("_new").over(in_order)).drop("_new")
