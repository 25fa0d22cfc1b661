"""Tables to read."""

from tabloom.sources.jdbc import read_dimensions, read_query
from tabloom.sources.partitions import empty_table, has_data, read_partition

__all__ = ["empty_table", "has_data", "read_dimensions", "read_partition", "read_query"]
