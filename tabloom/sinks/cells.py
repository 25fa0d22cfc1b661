"""Key/cell tables as ORC."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.cells import wide_to_cells
from tabloom.schema import Field
from tabloom.sinks.width import output_width


def write_cells(
    df: DataFrame,
    path: str,
    schema: Iterable[str | Field],
    row: str,
    family: str,
    mode: str = "append",
    partitions: int | None = None,
    shuffle: bool = False,
) -> None:
    """Write each row as cells of one family, keyed by the ``row`` column; see ``wide_to_cells``.

    ``version`` holds the time of the write in milliseconds, so that a cell written again
    replaces the earlier one for ``cells_to_wide(..., version="version")``.
    """
    cells = wide_to_cells(df, schema, row, family).withColumn("version", F.unix_millis(F.current_timestamp()))
    output_width(cells, partitions, shuffle).write.mode(mode).orc(path)
