"""Corrected locations of businesses, and the state dimension."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame

from placemill import schemas
from placemill.operators.geo import attach_place, place_index
from placemill.operators.rowindex import row_pages, row_range
from placemill.sinks.tables import TableSet, conform


def build_locations(
    inputs: Mapping[str, DataFrame],
    *,
    page: tuple[int, int] | None = None,
    order_by: Sequence[str] = ("business_id",),
    max_km: float = 50.0,
    cell_deg: float = 0.5,
) -> TableSet:
    """``business`` with ``ciudad`` and ``estado`` of the nearest ``gazetteer`` place.

    ``page`` takes a range of rows in key order. Pages that were written earlier
    (``done``, optional) are appended to the result. The gazetteer may be a
    ``PlaceIndex``; for all pages one by one take :func:`location_pages`.
    """
    business = inputs["business"]
    if page is not None:
        business = row_range(business, order_by, *page)
    placed = attach_place(business, inputs["gazetteer"], max_km=max_km, cell_deg=cell_deg)
    if "done" in inputs:
        placed = inputs["done"].unionByName(placed, allowMissingColumns=True)
    return TableSet({"business": placed})


def location_pages(
    inputs: Mapping[str, DataFrame],
    size: int,
    *,
    order_by: Sequence[str] = ("business_id",),
    max_km: float = 50.0,
    cell_deg: float = 0.5,
) -> Iterator[TableSet]:
    """The result of :func:`build_locations` in pages of ``size`` rows, in key order.

    The place index is built once and all page boundaries come from one selection.
    """
    index = place_index(inputs["gazetteer"], max_km=max_km, cell_deg=cell_deg)
    for page in row_pages(inputs["business"], order_by, size):
        yield build_locations({"business": page, "gazetteer": index})


def build_state_dimension(inputs: Mapping[str, DataFrame]) -> TableSet:
    """``states`` as read: names keep their trailing blank."""
    return TableSet({"estados_usa2": conform(inputs["states"], schemas.STATE_DIM)})
