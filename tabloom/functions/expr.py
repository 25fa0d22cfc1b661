"""Expressions whose meaning depends on the column types of the frame they are applied to.

Spark's own ``Column`` has no type until it is analysed, while ``add``, ``to_int`` or
``rjust`` choose what to do by type. An ``Expr`` is therefore a recipe: given a ``Scope``
(the input frame of a stage) it yields a plain ``Column``.

As in ``pyspark.sql.functions``, a ``str`` operand names a column and a literal is ``F.lit``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.schema import quoted


@dataclass(frozen=True)
class Expr:
    build: Callable[["Scope"], Column]


Operand = Union[str, Column, Expr]


@dataclass
class Scope:
    """The input of one stage, plus the lookup columns joined to it on the way."""

    source: DataFrame
    dimensions: Mapping[str, Any] = field(default_factory=dict)
    missing_as_null: bool = False

    def __post_init__(self) -> None:
        self.frame = self.source
        self.helpers: list[str] = []
        self.broadcast = 0  # bytes of lookups that are broadcast
        self._known: dict[int, tuple[Expr, Column, T.DataType]] = {}
        self.types = {f.name: f.dataType for f in self.source.schema}

    def column(self, operand: Operand) -> Column:
        return self.typed(operand)[0]

    def output(self, operand: Operand) -> Column:
        """The operand as a column that is used once."""
        return operand.build(self) if isinstance(operand, Expr) else self.typed(operand)[0]

    def typed(self, operand: Operand) -> tuple[Column, T.DataType]:
        """The operand as a column, and its type.

        An expression gets a column of its own in a projection below, so that whatever is made
        of it refers to it: plans grow with the number of expressions however they are nested,
        and each is evaluated once per row, also one that several others share.
        """
        if isinstance(operand, Expr):
            if id(operand) not in self._known:
                column = self.bound(operand.build(self))
                self._known[id(operand)] = operand, column, self.frame.select(column).schema[0].dataType
            return self._known[id(operand)][1:]
        if isinstance(operand, Column):
            # Resolving against the input alone keeps sibling outputs of the stage out of
            # reach; Spark would otherwise bind them as lateral column aliases.
            return operand, self.source.select(operand.alias("v")).schema["v"].dataType
        if operand in self.types:
            return F.col(quoted(operand)), self.types[operand]
        if self.missing_as_null:
            return F.lit(None).cast("string"), T.StringType()
        raise ValueError(f"no column {operand!r} in {self.source.columns}")

    def single(self, operand: Operand) -> tuple[Column, T.DataType]:
        """As ``typed``, with any operand that is more than a column's name worked out once."""
        column, data_type = self.typed(operand)
        return (self.bound(column) if isinstance(operand, Column) else column), data_type

    def bound(self, column: Column) -> Column:
        """The column under a name, to be used several times."""
        name = self.helper()
        self.frame = self.frame.withColumn(name, column)
        return F.col(name)

    def text(self, operand: Operand, what: str, several_times: bool = False) -> Column:
        """A string operand; anything else is a mistake found while planning."""
        column, data_type = self.single(operand) if several_times else self.typed(operand)
        if not isinstance(data_type, (T.StringType, T.NullType)):
            raise TypeError(f"{what} needs a string, got {data_type.simpleString()}")
        return column

    def helper(self) -> str:
        """A fresh column name for a value on the way; ``stage`` drops it again."""
        name = f"__helper_{len(self.helpers)}"
        self.helpers.append(name)
        return name


def literal(value: Any) -> Any:
    """Python values as literals, everything else untouched (as in ``F.when(c, value)``)."""
    return value if isinstance(value, (Column, Expr)) else F.lit(value)
