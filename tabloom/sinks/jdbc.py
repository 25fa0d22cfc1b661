"""Tables written over JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from tabloom.operators.projection import rename_to
from tabloom.schema import Field
from tabloom.sinks.width import output_width


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    schema: Iterable[str | Field],
    mode: str = "append",
    options: Mapping[str, str] | None = None,
    partitions: int | None = None,
    shuffle: bool = False,
    cast: bool = False,
) -> None:
    """Name columns after ``schema`` and write to a database table.

    Each task is one connection and one transaction; ``partitions`` bounds the connections,
    and ``options`` carry user, password, driver and batchsize. A task that is run again after
    its commit was lost writes its rows again, so a table with a primary key is the safe target.
    """
    out = output_width(rename_to(df, schema, cast), partitions, shuffle)
    out.write.mode(mode).jdbc(url, table, properties=dict(options or {}))
