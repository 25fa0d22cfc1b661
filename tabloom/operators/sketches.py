"""Distinct counts that can be added up: sketches stored by part, merged for any choice of parts.

An exact distinct count of a year cannot be had from those of its days. A sketch can: it is stored
once for each part of the table, in some kilobytes whatever the part's size, and the sketches of any
parts merge into that of all their rows. A new day costs a day, and a question about any days reads
their sketches alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a sketch as a power of two: 4 to 21.
PRECISION = 12


def relative_error(precision: int = PRECISION) -> float:
    """The standard error of an estimate, as a share of the number."""
    return 1.04 / math.sqrt(1 << precision)


def distinct_sketches(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], precision: int = PRECISION
) -> DataFrame:
    """A row for each group of ``by`` with a sketch, as text, of each column's distinct values; nulls are no values."""
    kinds = dict(df.dtypes)
    # the sketch knows whole numbers, texts and bytes
    known = ("int", "bigint", "string", "binary")
    value = lambda c: F.col(c) if kinds[c] in known else F.col(c).cast("string")
    return df.groupBy(*by).agg(*(F.base64(F.hll_sketch_agg(value(c), F.lit(precision))).alias(c) for c in columns))


def merged(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups, from those of their parts."""
    union = lambda c: F.base64(F.hll_union_agg(F.unbase64(c), F.lit(False))).alias(c)
    return sketches.groupBy(*by).agg(*map(union, columns))


def estimate(sketch: Column | str) -> Column:
    """About how many distinct values a sketch has seen."""
    return F.coalesce(F.hll_sketch_estimate(F.unbase64(sketch)), F.lit(0).cast("bigint"))
