"""Operators: each takes a DataFrame and returns one, without running it."""

from tabloom.operators.cells import cells_to_wide, wide_to_cells
from tabloom.operators.dimension import Dimension, dimension
from tabloom.operators.projection import project, project_json, rename_to, strip_prefix
from tabloom.operators.ranges import RangeDimension, in_range
from tabloom.operators.sizing import Limits
from tabloom.operators.stage import stage, stages

__all__ = [
    "Dimension",
    "Limits",
    "RangeDimension",
    "cells_to_wide",
    "dimension",
    "in_range",
    "project",
    "project_json",
    "rename_to",
    "stage",
    "stages",
    "strip_prefix",
    "wide_to_cells",
]
