"""Table loads, file exports and contiguous splits."""

from placemill.sinks.files import write_csv, write_json_arrays, write_parts
from placemill.sinks.loads import committed_loads, load_once, read_loads
from placemill.sinks.tables import TableSet, append_table, conform, save, write_all

__all__ = [
    "TableSet",
    "append_table",
    "committed_loads",
    "conform",
    "load_once",
    "read_loads",
    "save",
    "write_all",
    "write_csv",
    "write_json_arrays",
    "write_parts",
]
