"""Shape a table to a declared schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.schema import Field, declare, quoted, without_family


def project(df: DataFrame, schema: Iterable[str | Field]) -> DataFrame:
    """Declared columns in declared order and type; absent ones are null, others dropped."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(quoted(f.name)) if f.name in present else F.lit(None)).cast(f.data_type).alias(f.name)
            for f in declare(schema)
        )
    )


def rename_to(df: DataFrame, schema: Iterable[str | Field], cast: bool = False) -> DataFrame:
    """Name columns by position after the schema; ``cast`` also applies its types."""
    fields = declare(schema)
    if len(fields) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns {df.columns} for a schema of {len(fields)}")
    renamed = df.toDF(*(f.name for f in fields))
    if not cast:
        return renamed
    return renamed.select(*(F.col(quoted(f.name)).cast(f.data_type).alias(f.name) for f in fields))


def _stripped(names: list[str]) -> list[str]:
    short = [without_family(n) for n in names]
    if len(set(short)) != len(short):
        raise ValueError(f"names clash without their family: {names}")
    return short


def strip_prefix(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep ``family:qualifier`` columns, named by qualifier; absent ones are null text."""
    names = list(names)
    present = set(df.columns)
    return df.select(
        *(
            (F.col(quoted(n)) if n in present else F.lit(None).cast("string")).alias(short)
            for n, short in zip(names, _stripped(names))
        )
    )


def project_json(df: DataFrame, names: Iterable[str], column: str = "json") -> DataFrame:
    """The named columns of each row as JSON text, without family prefixes.

    Names of more than two parts and names the table lacks are left out, null values too.
    """
    kept = [n for n in names if n in set(df.columns) and n.count(":") < 2]
    return df.select(
        F.to_json(F.struct(*(F.col(quoted(n)).alias(s) for n, s in zip(kept, _stripped(kept))))).alias(column)
    )
