"""A two-way choice by comparing a value with text."""

from __future__ import annotations

import operator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.expr import Expr, Operand, Scope, literal

_COMPARE = {
    "eq": operator.eq,
    "ne": operator.ne,
    "lt": operator.lt,
    "le": operator.le,
    "gt": operator.gt,
    "ge": operator.ge,
}

_NUMBER = r"\A-?([0-9][0-9,]*(\.[0-9]*)?|\.[0-9]+)(E-?[0-9]+)?\z"


def number_of(text: Column) -> Column:
    """Number written in digits, thousands commas allowed; null when there is none.

    A minus sign may come first and ``E`` brings an exponent. A plus sign, blanks and ``e`` make no number.
    """
    return F.when(text.rlike(_NUMBER), F.replace(text, F.lit(","), F.lit("")).try_cast("double"))


def if_(x: Operand, method: str, compare, then, otherwise) -> Expr:
    """``then`` when the comparison holds, else ``otherwise``.

    Methods are ``eq ne lt le gt ge contains``. Strings compare as text, numbers as doubles
    with the number in ``compare``. A null or boolean value fails every comparison, ``ne``
    included; a text differs from a null it is compared with. Results are text, and the text
    ``NULL`` stands for null.
    Python values for ``compare``, ``then`` and ``otherwise`` are literals.
    """
    if method not in _COMPARE and method != "contains":
        raise ValueError(f"unknown method {method!r}, expected one of {[*_COMPARE, 'contains']}")

    def result(scope: Scope, branch) -> Column:
        text = scope.text(literal(branch), "a result of if_").cast("string")
        return F.nullif(text, F.lit("NULL"))

    def build(scope: Scope) -> Column:
        column, data_type = scope.single(x)
        other = scope.column(literal(compare)).cast("string")
        if method == "contains":
            holds = F.contains(column.cast("string"), other)
        elif isinstance(data_type, T.StringType):
            holds = _COMPARE[method](column, other)
            if method == "ne":
                holds |= column.isNotNull() & other.isNull()
        elif isinstance(data_type, T.NumericType):
            number, wanted = column.cast("double"), number_of(other)
            # NaN differs from every number here; Spark would rank it above all of them.
            nan_result = wanted.isNotNull() if method == "ne" else F.lit(False)
            holds = F.when(F.isnan(number), nan_result).otherwise(_COMPARE[method](number, wanted))
        else:
            holds = F.lit(False)
        # A null condition takes the second branch in CASE WHEN, as wanted here.
        return F.when(holds, result(scope, then)).otherwise(result(scope, otherwise))

    return Expr(build)
