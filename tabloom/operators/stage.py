"""Apply a set of column expressions to a table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from tabloom.functions.expr import Operand, Scope


def stage(
    df: DataFrame,
    outputs: Mapping[str, Operand],
    dimensions: Mapping[str, object] | None = None,
    missing_as_null: bool = False,
) -> DataFrame:
    """All input columns plus ``outputs``, which replace input columns of the same name.

    Every expression reads the input row: an output is not visible to its siblings, so two
    columns can be swapped. Lookups become left joins below one projection.
    """
    scope = Scope(df, dimensions or {}, missing_as_null)
    columns = {name: scope.output(operand) for name, operand in outputs.items()}
    return scope.frame.withColumns(columns).drop(*scope.helpers)


def stages(df: DataFrame, steps: list[Mapping[str, Operand]], dimensions=None, missing_as_null=False) -> DataFrame:
    """Stages in order, each reading what the one before it gave."""
    return reduce(lambda frame, outputs: stage(frame, outputs, dimensions, missing_as_null), steps, df)
