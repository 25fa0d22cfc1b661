"""One query per operator, over the test tables."""

from tabloom.queries import expressions, lookups, ordered, relational, shaping, totals, transfer
from tabloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "expressions", "lookups", "ordered", "relational", "shaping", "totals", "transfer"]
