"""File scans with declared schemas, and file inventories."""

from placemill.sources.inventory import list_files, parent_globs
from placemill.sources.readers import (
    POSITION,
    read_delimited,
    read_json,
    read_json_objects,
    read_many,
    read_parquet,
    with_position,
)

__all__ = [
    "POSITION",
    "list_files",
    "parent_globs",
    "read_delimited",
    "read_json",
    "read_json_objects",
    "read_many",
    "read_parquet",
    "with_position",
]
