"""Schema declarations: ``"name;type"`` or ``"name;type;default expression"`` per field."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import types as T

# The type names a declaration may use.
TYPES = {
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "long": T.LongType(),
    "short": T.ShortType(),
    "timestamp": T.TimestampType(),
}


class Field(NamedTuple):
    name: str
    type: str
    default: str | None = None

    @property
    def data_type(self) -> T.DataType:
        return TYPES[self.type]


def declare(specs: Iterable[str | Field]) -> list[Field]:
    """Read a declaration; every error in it is raised here, before any plan is built."""
    fields = []
    for spec in specs:
        parts = spec if isinstance(spec, Field) else [part.strip() for part in spec.split(";", 2)]
        if len(parts) < 2:
            raise ValueError(f"field {spec!r} has no type")
        fields.append(Field(*parts))
    for f in fields:
        if f.type not in TYPES:
            raise ValueError(f"field {f.name!r}: unknown type {f.type!r}, expected one of {sorted(TYPES)}")
    names = [f.name for f in fields]
    if len(set(names)) != len(names):
        raise ValueError(f"field declared twice in {names}")
    return fields


def struct(specs: Iterable[str | Field]) -> T.StructType:
    """The declaration as an all-nullable ``StructType``."""
    return T.StructType([T.StructField(f.name, f.data_type, True) for f in declare(specs)])


def quoted(name: str) -> str:
    """A column name that resolves as is, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def without_family(name: str) -> str:
    """``family:qualifier`` -> ``qualifier``; a plain name stays."""
    parts = name.split(":")
    if len(parts) > 2:
        raise ValueError(f"{name!r} has more than one ':'")
    return parts[-1]
