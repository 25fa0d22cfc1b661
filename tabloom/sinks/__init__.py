"""Tables to write."""

from tabloom.sinks.cells import write_cells
from tabloom.sinks.jdbc import write_jdbc
from tabloom.sinks.orc import add_partitions, register_orc_table, write_orc
from tabloom.sinks.publish import clean, publish_orc, published, read_published
from tabloom.sinks.width import output_width

__all__ = [
    "add_partitions",
    "clean",
    "output_width",
    "publish_orc",
    "published",
    "read_published",
    "register_orc_table",
    "write_cells",
    "write_jdbc",
    "write_orc",
]
