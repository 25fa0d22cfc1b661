"""Text conversion, padding and search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.expr import Expr, Operand, Scope, literal

_AS_TEXT = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_SMALL_INT = (T.ByteType, T.ShortType, T.IntegerType)
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def parse_int(text: Column, on_error: str = "raise") -> Column:
    """Strict 32-bit parse: sign and digits only, no blanks; null stays null."""
    number = F.when(text.rlike(r"\A[+-]?\d+\z"), text.try_cast("int"))
    if on_error == "null":
        return number
    if on_error != "raise":
        raise ValueError(f"on_error is 'raise' or 'null', got {on_error!r}")
    failure = F.raise_error(F.concat(F.lit("not an int: "), text)).cast("int")
    return F.when(text.isNotNull(), F.coalesce(number, failure))


def to_str(x: Operand) -> Expr:
    """Text of a string or number; null and every other type give ``""``."""

    def build(scope: Scope) -> Column:
        column, data_type = scope.typed(x)
        if not isinstance(data_type, _AS_TEXT):
            return F.lit("")
        return F.coalesce(column.cast("string"), F.lit(""))

    return Expr(build)


def to_int(x: Operand, on_error: str = "raise") -> Expr:
    """Text is parsed strictly, 32-bit values pass, null and everything else give 0.

    ``on_error="null"`` gives null instead of failing on text that is no number.
    """

    def build(scope: Scope) -> Column:
        column, data_type = scope.single(x)
        if isinstance(data_type, T.StringType):
            return F.when(column.isNull(), F.lit(0)).otherwise(parse_int(column, on_error))
        if isinstance(data_type, _SMALL_INT):
            return F.coalesce(column.cast("int"), F.lit(0))
        if isinstance(data_type, T.LongType):
            return F.when(column.between(_INT_MIN, _INT_MAX), column.cast("int")).otherwise(F.lit(0))
        return F.lit(0)

    return Expr(build)


def rjust(x: Operand, width: int, on_error: str = "raise") -> Expr:
    """Zero-pad to ``width`` with thousands commas; null gives null.

    32-bit integers and text holding one are padded, any other value is its plain text.
    """
    if int(width) < 1:
        raise ValueError(f"width must be positive, got {width}")
    pattern = f"%1$,0{int(width)}d"

    def build(scope: Scope) -> Column:
        column, data_type = scope.single(x)
        if isinstance(data_type, T.StringType):
            number = scope.bound(parse_int(column, on_error))
            return F.when(number.isNotNull(), F.format_string(pattern, number))
        if isinstance(data_type, _SMALL_INT):
            return F.when(column.isNotNull(), F.format_string(pattern, column.cast("int")))
        if isinstance(data_type, T.LongType):
            padded = F.format_string(pattern, column)
            return F.when(column.between(_INT_MIN, _INT_MAX), padded).otherwise(column.cast("string"))
        return column.cast("string")

    return Expr(build)


def contains(x: Operand, sub: str | Column | Expr) -> Expr:
    """1 when the text holds ``sub`` (case-sensitive), else 0; a null on either side is 0."""

    def build(scope: Scope) -> Column:
        text, part = scope.text(x, "contains"), scope.text(literal(sub), "contains")
        return F.coalesce(F.contains(text, part).cast("int"), F.lit(0))

    return Expr(build)
