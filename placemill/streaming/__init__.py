"""Tables built from files as they arrive."""

from placemill.streaming.ingest import BatchFolders, Route, first_arrivals, ingest, ingest_routes
from placemill.streaming.router import deal, ingest_by_name

__all__ = [
    "BatchFolders",
    "Route",
    "deal",
    "first_arrivals",
    "ingest",
    "ingest_by_name",
    "ingest_routes",
]
