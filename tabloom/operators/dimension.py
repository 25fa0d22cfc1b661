"""Key lookups: one or more key -> value maps tried in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.durable import new_folder, removed
from tabloom.functions.expr import Expr, Operand, Scope
from tabloom.operators.sizing import Limits, Size, at_once, join_lookup, settled
from tabloom.schema import quoted


def comparable(key: Column, data_type: T.DataType) -> Column:
    """The form keys are grouped in: whole numbers as such, which equal as their text does."""
    return key.cast("bigint" if isinstance(data_type, T.IntegralType) else "string")


def key_value(df: DataFrame, order_by: str | None = None) -> DataFrame:
    """A map ``(k, v)`` from the first column to the second, one row per key.

    Of several rows with one key the highest ``order_by`` wins, then the highest value;
    without an order column the highest value. The maximum is combined map-side, so a key
    with very many copies costs no more than any other.
    """
    if len(df.columns) < 2:
        raise ValueError(f"a map needs a key and a value column, got {df.columns}")
    key, value = (F.col(quoted(c)) for c in df.columns[:2])
    by_key = df.groupBy(comparable(key, df.schema[0].dataType).alias("k"))
    if order_by is None:
        return by_key.agg(F.max(value).alias("v"))
    latest = F.max(F.struct(F.col(quoted(order_by)).alias("o"), value.alias("v")))
    return by_key.agg(latest.alias("b")).select("k", F.col("b.v").alias("v"))


class Dimension:
    """Maps under one alias; the i-th key of a lookup is searched in the i-th map."""

    def __init__(self, *maps: DataFrame, order_by: str | None = None, limits: Limits = Limits()):
        if not maps:
            raise ValueError("a dimension needs at least one map")
        self.maps = [key_value(m, order_by) for m in maps]
        self.limits = limits
        self._settled: dict[int, tuple[DataFrame, Size]] = {}
        self._folder = Folder()

    def settled(self, n: int) -> list[tuple[DataFrame, Size]]:
        """The first ``n`` maps as stored tables and their sizes; worked out at their first use."""
        folder = self._folder.path(self.maps[0].sparkSession)

        def one(i: int) -> tuple[DataFrame, Size]:
            if i not in self._settled:
                self._settled[i] = settled(self.maps[i], "k", "dimension", folder)
            return self._settled[i]

        return at_once(one, n)

    def release(self) -> None:
        """Delete the stored tables; plans that look up in them can no longer run."""
        self._settled.clear()
        self._folder.remove()


class Folder:
    """Where one dimension's tables are stored, made at its first use."""

    def __init__(self):
        self._made: tuple[SparkSession, str] | None = None

    def path(self, spark: SparkSession) -> str:
        if self._made is None:
            self._made = spark, new_folder(spark, "dimension")
        return self._made[1]

    def remove(self) -> None:
        if self._made:
            removed(*self._made)
            self._made = None


def find(scope: Scope, alias: str | Dimension, kind: type, maps_needed: int):
    found = scope.dimensions.get(alias) if isinstance(alias, str) else alias
    if found is None:
        raise ValueError(f"no dimension {alias!r}, known are {sorted(scope.dimensions)}")
    if not isinstance(found, kind):
        raise TypeError(f"{alias!r} is a {type(found).__name__}, not a {kind.__name__}")
    if not 1 <= maps_needed <= len(found.maps):
        raise ValueError(f"{maps_needed} keys for {len(found.maps)} maps")
    return found


def first_found(scope: Scope, values: list[Column]) -> Column:
    """The first value that is not null; maps of different types are an error."""
    joined = scope.frame.select(*(v.alias(f"v{i}") for i, v in enumerate(values)))
    types = {data_type for _, data_type in joined.dtypes}
    if len(types) > 1:
        raise TypeError(f"the maps hold values of different types: {sorted(types)}")
    return F.coalesce(*values)


def dimension(alias: str | Dimension, *keys: Operand) -> Expr:
    """Value of the first key that has one; null without a match.

    Keys are compared as text, and a null key matches a map's null key.
    """

    def build(scope: Scope) -> Column:
        found = find(scope, alias, Dimension, len(keys))
        values = []
        for key, (table, size) in zip(keys, found.settled(len(keys))):
            column, data_type = scope.typed(key)
            k, v = scope.helper(), scope.helper()
            side = table.toDF(k, v)
            column = comparable(column, data_type)
            if isinstance(side.schema[k].dataType, T.LongType) != isinstance(data_type, T.IntegralType):
                side, column = side.withColumn(k, F.col(k).cast("string")), column.cast("string")
            join_lookup(scope, column, side, size, found.limits)
            values.append(F.col(v))
        return first_found(scope, values)

    return Expr(build)
