"""``+`` over operands: the first one decides between concatenation and addition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.expr import Expr, Operand, Scope

_INT = (T.ByteType, T.ShortType, T.IntegerType)
_WHOLE = (*_INT, T.LongType)
_FAMILIES = ((T.StringType,), _INT, (T.LongType,), (T.FloatType,), (T.DoubleType,))
_SPAN, _HALF = 2**32, 2**31


def _wrapped_int(total: Column) -> Column:
    """A 64-bit sum reduced to 32 bits, wrapping around as two's complement does."""
    return (F.pmod(total + F.lit(_HALF), F.lit(_SPAN)) - F.lit(_HALF)).cast("int")


def add(first: Operand, *rest: Operand) -> Expr:
    """Fold operands by the type of the first.

    Strings are joined (a later null appends the text ``null``), integers add with 32-bit
    wrap-around, long, float and double add as such. Whole numbers of different width add as
    long. A null first operand gives null, and so does one of any other type. One operand alone
    is passed through with its type.
    """

    def build(scope: Scope) -> Column:
        head, head_type = scope.typed(first)
        if not rest:
            return head
        tail = [scope.typed(operand) for operand in rest]
        family = next((f for f in _FAMILIES if isinstance(head_type, f)), None)
        if family is None:
            return F.lit(None).cast("string")
        if family == _INT and any(isinstance(t, T.LongType) for _, t in tail):
            family, head_type = (T.LongType,), T.LongType()
        accepted = _WHOLE if family == (T.LongType,) else family
        for _, data_type in tail:
            if not isinstance(data_type, (*accepted, T.NullType)):
                raise TypeError(f"cannot add {data_type.simpleString()} to {head_type.simpleString()}")
        columns = [head, *(c for c, _ in tail)]
        if family == (T.StringType,):
            texts = [head, *(F.coalesce(c.cast("string"), F.lit("null")) for c in columns[1:])]
            return F.when(head.isNotNull(), F.concat(*texts))
        if family == _INT:
            return _wrapped_int(reduce(Column.__add__, (c.cast("bigint") for c in columns)))
        return reduce(Column.__add__, (c.cast(head_type) for c in columns))

    return Expr(build)


def value(x: Operand) -> Expr:
    """The operand as it is."""
    return Expr(lambda scope: scope.column(x))
