"""Column functions of a stage. All of them stay inside Spark's own expressions."""

from tabloom.functions.arithmetic import add, value
from tabloom.functions.conditions import if_
from tabloom.functions.text import contains, rjust, to_int, to_str
from tabloom.functions.times import reformat_date, strftime, strptime

__all__ = ["add", "contains", "if_", "reformat_date", "rjust", "strftime", "strptime", "to_int", "to_str", "value"]
