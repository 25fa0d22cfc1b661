"""What several operators share: texts and words, names that do not clash, Python for workers."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words.
WHITE = " \t\n\x0b\f\r"
NOT_WORD = r"[\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(column: str | Column) -> Column:
    """A text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """The runs of characters that are not white space, as an array."""
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, NOT_WORD, -1))


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone."""
    return F.translate(text, _UPPER, _UPPER.lower())


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used and wherever filters go."""
    return F.get(F.transform(F.array(value), use), 0)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores added until the table has no such column."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it."""
    context = spark.sparkContext
    if getattr(context, "_tabloom_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tabloom-ship-"), "tabloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._tabloom_shipped = True
