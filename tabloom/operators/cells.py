"""Key/cell tables: one row per (rowkey, family, qualifier) against one wide row per key."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.durable import written
from tabloom.schema import Field, declare, quoted

_NESTED = (T.StructType, T.ArrayType, T.MapType)
# Bits of the fraction and bias of the exponent.
_IEEE = {T.DoubleType: (52, 1023), T.FloatType: (23, 127)}
#: Hash values of row keys by which cells are counted.
_BUCKETS = 65_536


def _declared(names: list[str]) -> Column:
    """Condition on the stored columns, so that it reaches the scan."""
    by_family: dict[str, list[str]] = {}
    for name in names:
        family, qualifier = name.split(":", 1)
        by_family.setdefault(family, []).append(qualifier)
    return reduce(
        Column.__or__, ((F.col("family") == f) & F.col("qualifier").isin(q) for f, q in by_family.items())
    )


def cells_to_wide(
    cells: DataFrame,
    names: Iterable[str],
    version: str | None = None,
    keep_empty: bool = True,
    task_cells: int = 250_000,
    under: str | None = None,
) -> DataFrame:
    """One row per ``rowkey``, as text, with a text column for each declared ``family:qualifier``.

    Of several versions of a cell the highest ``version`` is kept. The columns are conditional
    maxima of a grouping, which sorts, as text does not fit a hash aggregate. So cells are counted by the hash of
    their row key and dealt by it, to as many tasks as have ``task_cells`` each to sort. Keys among more cells
    than that are dealt in parts, each first reduced to one row, so that a key holding much of the table does not
    gather anywhere. Of an undeclared cell no more than its row key is sent. Cells are read twice.

    Every row key of the table appears, also one that has none of the declared cells. Where
    such rows are not wanted, ``keep_empty=False`` reads the declared cells only.
    """
    names = list(names)
    kept = _kept(cells, names, version, keep_empty).withColumn("bucket", F.pmod(F.xxhash64("rowkey"), F.lit(_BUCKETS)))
    counted = written(kept.groupBy("bucket").agg(F.count(F.lit(1)).alias("cells")), "cell-counts", under)
    total, most = (n or 0 for n in counted.agg(F.sum("cells"), F.max("cells")).first())
    tasks = max(2, -(-total // task_cells))  # one would be a gathering of the whole table to Spark
    if most <= task_cells:
        return _named(_picked(kept.repartition(tasks, "rowkey"), names), names)
    parts = F.ceil(F.col("cells") / task_cells).alias("parts")
    hot = written(counted.where(F.col("cells") > task_cells).select("bucket", parts), "hot-cells", under)
    dealt = kept.join(F.broadcast(hot), "bucket", "left")
    plain = _picked(dealt.where("parts is null").repartition(tasks, "rowkey"), names)
    in_parts = dealt.where("parts is not null").withColumn("part", F.pmod(F.monotonically_increasing_id(), "parts"))
    reduced = _picked(in_parts.repartition(tasks, "rowkey", "part"), names, "part")
    best = [F.max(f"c{i}").alias(f"c{i}") for i in range(len(names))]
    return _named(plain.unionByName(reduced.repartition(tasks, "rowkey").groupBy("rowkey").agg(*best)), names)


def gathered_wide(
    cells: DataFrame, names: Iterable[str], version: str | None = None, keep_empty: bool = True
) -> DataFrame:
    """``cells_to_wide`` of cells that are stored by row key, in order: neither shuffled nor sorted."""
    names = list(names)
    return _named(_picked(_kept(cells, names, version, keep_empty), names), names)


def _kept(cells: DataFrame, names: list[str], version: str | None, keep_empty: bool) -> DataFrame:
    """Of each cell its row key, the place of its column, and its version and value where that is declared."""
    rank = F.col(quoted(version)) if version else F.lit(0)
    cell = F.struct(rank.alias("rank"), F.col("value").cast("string").alias("value"))
    # the place of a cell's column, worked out once per cell and compared as a number from then on
    places = {tuple(n.split(":", 1)): i for i, n in enumerate(names)}
    by_family = {f: F.lit(None).cast("int") for f, _ in places}
    for (family, qualifier), place in reversed(places.items()):
        by_family[family] = F.when(F.col("qualifier") == qualifier, place).otherwise(by_family[family])
    place = F.lit(None).cast("int")
    for family, of_qualifier in by_family.items():
        place = F.when(F.col("family") == family, of_qualifier).otherwise(place)
    if not keep_empty:
        cells = cells.where(_declared(names))
    placed = cells.withColumn("place", place)
    # of an undeclared cell nothing but its row key goes on
    return placed.select("rowkey", "place", F.when(F.col("place").isNotNull(), cell).alias("cell"))


def _picked(kept: DataFrame, names: list[str], *parts: str) -> DataFrame:
    """For each row key, and part of it, the best cell of each column."""
    picked = [F.max(F.when(F.col("place") == i, F.col("cell"))).alias(f"c{i}") for i in range(len(names))]
    return kept.groupBy("rowkey", *parts).agg(*picked)


def _named(picked: DataFrame, names: list[str]) -> DataFrame:
    values = (F.col(f"c{i}").getField("value").alias(n) for i, n in enumerate(names))
    return picked.select(F.col("rowkey").cast("string"), *values)


def _int_bytes(column: Column) -> Column:
    return F.unhex(F.lpad(F.hex(F.pmod(column.cast("bigint"), F.lit(2**32))), 8, "0"))


def _long_bytes(column: Column) -> Column:
    return F.unhex(F.lpad(F.hex(column.cast("bigint")), 16, "0"))


def _with_bits(df: DataFrame) -> DataFrame:
    """Floating-point columns replaced by their IEEE bits, as whole numbers.

    Spark has no function for the bits that compiles, and calling Java by reflection costs some
    twenty times this arithmetic. It is exact: numbers are only scaled by powers of two, and the
    logarithm is no more than a first guess at the exponent. The steps are projections of their
    own so that each is computed once.
    """
    layouts = {f.name: _IEEE[type(f.dataType)] for f in df.schema if type(f.dataType) in _IEEE}

    def step(frame: DataFrame, name: str, make) -> DataFrame:
        return frame.withColumns({f"__{name}_{c}": make(c, *layout) for c, layout in layouts.items()})

    def of(name: str, column: str) -> Column:
        return F.col(quoted(f"__{name}_{column}"))

    def power(exponent: Column) -> Column:
        return F.pow(F.lit(2.0), exponent)

    def exponent(c, fraction_bits, bias):
        size, guess = of("size", c), of("guess", c)
        return F.when(size >= power(guess + 1), guess + 1).when(size < power(guess), guess - 1).otherwise(guess)

    def bits(c, fraction_bits, bias):
        size, known, fraction = of("size", c), of("exponent", c), of("fraction", c)
        whole, infinity = 2**fraction_bits, (2 * bias + 1) * 2**fraction_bits
        # numbers below the least exponent keep it, without the leading one
        lead = F.when(fraction >= 1, (known + bias) * F.lit(whole) - F.lit(whole)).otherwise(F.lit(0))
        number = F.col(quoted(c)).cast("double")
        positive = (
            F.when(F.isnan(number), F.lit(infinity + whole // 2))
            .when(size == float("inf"), F.lit(infinity))
            .when(size == 0, F.lit(0))
            .when(size.isNotNull(), lead + (fraction * F.lit(float(whole))).cast("bigint"))
        )
        # -0.0 and 0.0 compare as equal, only their text differs
        negative = (number < 0) | ((size == 0) & (number.cast("string") == "-0.0"))
        sign_bit = -(2 ** (fraction_bits + (bias + 1).bit_length()))
        return positive + F.when(negative, F.lit(sign_bit)).otherwise(F.lit(0))

    frame = step(df, "size", lambda c, *_: F.abs(F.col(quoted(c)).cast("double")))
    frame = step(frame, "guess", lambda c, _, bias: F.least(F.floor(F.log2(of("size", c))), F.lit(bias)))
    frame = step(frame, "near", exponent)
    frame = step(frame, "exponent", lambda c, _, bias: F.greatest(of("near", c), F.lit(1 - bias)))
    frame = step(frame, "fraction", lambda c, *_: of("size", c) / power(of("exponent", c)))
    all_bits = {c: bits(c, *layout) for c, layout in layouts.items()}
    return frame.select(*(all_bits.get(c, F.col(quoted(c))).alias(c) for c in df.columns))


def _encode(column: Column, data_type: T.DataType) -> Column | None:
    """Bytes of a cell value, numbers big-endian; None for a type cells cannot hold.

    A floating-point column comes as its bits.
    """
    if isinstance(data_type, T.StringType):
        return column.cast("binary")
    if isinstance(data_type, _NESTED):
        return F.when(column.isNotNull(), F.to_json(column).cast("binary"))
    if isinstance(data_type, (T.IntegerType, T.FloatType)):
        return _int_bytes(column)
    if isinstance(data_type, (T.LongType, T.DoubleType)):
        return _long_bytes(column)
    if isinstance(data_type, T.BooleanType):
        return F.when(column.isNotNull(), F.when(column, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("00"))))
    return None


def wide_to_cells(df: DataFrame, schema: Iterable[str | Field], row: str, family: str) -> DataFrame:
    """One cell per value that is not null, the key column included; no shuffle.

    Columns are taken by schema position. Types without an encoding (short, date, timestamp,
    decimal) give no cells, with a warning. A null row key fails the job.
    """
    fields = declare(schema)
    names = [f.name for f in fields]
    if row not in names:
        raise ValueError(f"row key {row!r} is not in the schema {names}")
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns {df.columns} for a schema of {len(names)}")
    wide = df.toDF(*names)
    encoded = {f.name: _encode(F.col(quoted(f.name)), f.dataType) for f in wide.schema}
    skipped = [n for n, c in encoded.items() if c is None]
    if row in skipped:
        raise TypeError(f"row key {row!r} has no byte encoding")
    if skipped:
        warnings.warn(f"no cells for columns without a byte encoding: {skipped}", stacklevel=2)
    # The key is checked as one of the cells too, so that a row of nothing but nulls also fails.
    key = encoded[row] = F.coalesce(encoded[row], F.raise_error(F.lit(f"null row key {row}")).cast("binary"))
    cells = [part for n, c in encoded.items() if c is not None for part in (F.lit(n), c)]
    return (
        _with_bits(wide)
        .select(key.alias("rowkey"), F.stack(F.lit(len(cells) // 2), *cells).alias("qualifier", "value"))
        .where(F.col("value").isNotNull())
        .select("rowkey", F.lit(family).alias("family"), "qualifier", "value")
    )
