"""A SELECT list generated from a schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tabloom.operators.projection import rename_to
from tabloom.schema import Field, declare, quoted


def generated_select(
    spark: SparkSession,
    schema: Iterable[str | Field],
    select: Mapping[str, str],
    source: str,
    where: str | None = None,
) -> DataFrame:
    """One expression per schema field, in order, over ``source`` (any FROM text).

    A field takes its expression from ``select``, else its declared default, else the column
    of its name. Entries of ``select`` that are no field are ignored. The expressions see
    only the source: names are given afterwards, by position.
    """
    if not source:
        raise ValueError("a generated select needs a source")
    fields = declare(schema)
    listed = [select.get(f.name, f.default or quoted(f.name)) for f in fields]
    statement = f"SELECT {', '.join(listed)} FROM {source}" + (f" WHERE {where}" if where else "")
    return rename_to(spark.sql(statement), fields)
