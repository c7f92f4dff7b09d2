"""Reading and writing of plain and versioned tables."""

from .tables import first_rows, key_bound, raw_tables, read_table, scan, write_table
from .versions import VersionedTable
from .workspace import run_folder

__all__ = [
    "VersionedTable",
    "first_rows",
    "key_bound",
    "raw_tables",
    "read_table",
    "run_folder",
    "scan",
    "write_table",
]
