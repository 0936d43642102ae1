"""Nearest named place for coordinates.

The gazetteer is turned into a grid index: per cell, the places that can be the
nearest one for some point in the cell. A point then needs two equality lookups
and never meets the rest of the gazetteer.

Which places a cell keeps is exact. The points closer to one place than to
another form a half of the sphere, so if all corners of a cell are closer to the
one, the whole cell is, and the other cannot win there. Cells that keep many
places are cut into four and indexed again, which keeps the lists short in dense
areas.

The cells that are not cut further are ranges of a space-filling curve that do not overlap,
whatever their depth. The first lookup gives a point's outermost cell with the sorted
starts of the ranges in it; a binary search among them gives the range, and the
second lookup its places.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.operators.spread import spread_join
from placemill.runtime import broadcast_if_small, cut_lineage

EARTH_KM = 6371.0088
KM_PER_DEGREE = EARTH_KM * math.pi / 180
DENSE_CELL = 64  # places in one cell above which the cell is cut into four
MAX_LEVEL = 12
SLACK = 1e-13  # rounding of cosines: places this close to a tie are kept
SLACK_KM = 0.1  # the same for distances taken from cosines


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of two points given in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (
        half_lon * half_lon
    )
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_KM)


@dataclass(frozen=True)
class PlaceIndex:
    """A gazetteer made ready for lookups; made once, used for any number of points."""

    #: (_row, _col, _starts): outermost cells and the ranges of the curve in each.
    cells: DataFrame
    #: (_row, _col, _start, _end, _places): the places of each range.
    ranges: DataFrame
    most_ranges: int  # in one cell
    max_km: float
    cell_deg: float


def place_index(gazetteer: DataFrame, *, max_km: float = 50.0, cell_deg: float = 0.5) -> PlaceIndex:
    """The index of ``gazetteer`` (city, state, latitude, longitude) for distances to ``max_km``."""
    levels = _grid_index(gazetteer, max_km, cell_deg)
    ranges = None
    for level, index in enumerate(levels):
        inner, size = (1 << level) - 1, 1 << 2 * (MAX_LEVEL - level)
        code = _interleaved(F.col("_row").bitwiseAND(inner), F.col("_col").bitwiseAND(inner))
        here = index.select(
            F.shiftright("_row", level).alias("_row"),
            F.shiftright("_col", level).alias("_col"),
            (code * size).alias("_start"),
            ((code + 1) * size).alias("_end"),
            "_places",
        )
        ranges = here if ranges is None else ranges.unionAll(here)
    ranges = cut_lineage(ranges)
    cells = ranges.groupBy("_row", "_col").agg(F.array_sort(F.collect_list("_start")).alias("_starts"))
    cells = cut_lineage(cells)
    most = cells.agg(F.max(F.size("_starts"))).first()[0] or 1
    return PlaceIndex(cells, ranges, most, max_km, cell_deg)


def attach_place(
    df: DataFrame,
    gazetteer: DataFrame | PlaceIndex,
    *,
    max_km: float = 50.0,
    cell_deg: float = 0.5,
    out: tuple[str, str] = ("ciudad", "estado"),
) -> DataFrame:
    """Add the city and state of the nearest place within ``max_km``, or nulls.

    ``df`` has ``latitude`` and ``longitude``; ties go to the smaller (city,
    state). A gazetteer within the broadcast bounds needs no shuffle of ``df``. A
    ``PlaceIndex`` brings its own ``max_km`` and ``cell_deg``.
    """
    index = gazetteer
    if not isinstance(index, PlaceIndex):
        index = place_index(gazetteer, max_km=max_km, cell_deg=cell_deg)
    lat, lon = F.col("latitude"), F.col("longitude")
    finest = index.cell_deg / 2**MAX_LEVEL
    inner = (1 << MAX_LEVEL) - 1
    row, col = _row_of(lat, finest), F.floor(_wrap(lon) / finest)
    located = df.withColumns(
        {
            "_row": F.shiftright(row, MAX_LEVEL),
            "_col": F.shiftright(col, MAX_LEVEL),
            "_code": _interleaved(row.bitwiseAND(inner), col.bitwiseAND(inner)),
        }
    )
    found = spread_join(located, broadcast_if_small(index.cells), ["_row", "_col"], "left")
    start = F.get("_starts", _last_at_or_below(F.col("_starts"), F.col("_code"), index.most_ranges))
    found = found.withColumn("_start", start).drop("_starts")
    found = spread_join(found, broadcast_if_small(index.ranges), ["_row", "_col", "_start"], "left")
    ranked = F.transform(
        F.when(F.col("_code") < F.col("_end"), F.col("_places")),
        lambda place: F.struct(
            haversine_km(lat, lon, place["latitude"], place["longitude"]).alias("km"),
            place["city"].alias("city"),
            place["state"].alias("state"),
        ),
    )
    best = F.array_min(F.filter(ranked, lambda place: place["km"] <= index.max_km))
    return (
        found.withColumn("_best", best)
        .withColumns({out[0]: F.col("_best.city"), out[1]: F.col("_best.state")})
        .drop("_best", "_row", "_col", "_code", "_start", "_end", "_places")
    )


def _interleaved(row: Column, col: Column) -> Column:
    """The bits of two numbers below 2**16 in turn: the place on a Z-order curve."""

    def spread(value: Column) -> Column:
        value = value.cast("long")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return value

    return F.shiftleft(spread(row), 1).bitwiseOR(spread(col))


def _last_at_or_below(values: Column, value: Column, most: int) -> Column:
    """Index of the last of up to ``most`` ordered values at or below a value, or -1."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(most.bit_length()))])

    def halve(at: Column, step: Column) -> Column:
        passed = (at + step < F.size(values)) & (F.get(values, at + step) <= value)
        return F.when(passed, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(-1), halve)


def _wrap(lon: Column) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def _row_of(lat: Column, size: float) -> Column:
    """The grid row of a latitude; the pole belongs to the last row."""
    return F.least(F.floor(lat / size), F.lit(round(90 / size) - 1))


def _grid_index(gazetteer: DataFrame, max_km: float, cell_deg: float) -> list[DataFrame]:
    """Per level, ``(_row, _col, _places)`` of the cells that are not cut further."""
    if cell_deg <= 0 or abs(90 / cell_deg - round(90 / cell_deg)) > 1e-9:
        raise ValueError("cell_deg must divide 90")
    usable = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    places = (
        gazetteer.filter(usable)
        .groupBy("latitude", _wrap(F.col("longitude")).alias("longitude"))
        .agg(F.min(F.struct("city", "state")).alias("_name"))
        .select("latitude", "longitude", "_name.city", "_name.state")
    )
    members = _near_cells(places, max_km, cell_deg)
    levels = []
    for level in range(MAX_LEVEL + 1):
        kept = cut_lineage(_possible_nearest(members, max_km, cell_deg / 2**level))
        sizes = kept.groupBy("_row", "_col").agg(F.count("*").alias("_size"))
        dense = sizes.filter(F.col("_size") > DENSE_CELL).select("_row", "_col")
        more = level < MAX_LEVEL and not dense.isEmpty()
        leaves = spread_join(kept, dense, ["_row", "_col"], "left_anti") if more else kept
        places = F.collect_list(F.struct("latitude", "longitude", "city", "state"))
        levels.append(leaves.groupBy("_row", "_col").agg(places.alias("_places")))
        if not more:
            break
        halves = F.array(F.lit(0), F.lit(1))
        members = (
            spread_join(kept, dense, ["_row", "_col"], "left_semi")
            .withColumn("_row", F.explode(F.transform(halves, lambda h: F.col("_row") * 2 + h)))
            .withColumn("_col", F.explode(F.transform(halves, lambda h: F.col("_col") * 2 + h)))
        )
    return levels


def _near_cells(places: DataFrame, max_km: float, size: float) -> DataFrame:
    """Every place once per cell that has a point within ``max_km`` of it.

    Near the poles a cell row is short, so all its cells are taken.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    reach = max_km / KM_PER_DEGREE + 1e-9
    rows = F.sequence(
        F.greatest(F.floor((lat - reach) / size), F.lit(-round(90 / size))),
        _row_of(lat + reach, size),
    )
    # Widest longitude reach over the rows: at the latitude closest to a pole.
    widest = F.cos(F.radians(F.least(F.abs(lat) + reach, F.lit(90.0))))
    ratio = math.sin(min(reach, 90.0) * math.pi / 180) / F.greatest(widest, F.lit(1e-9))
    lon_reach = F.when(ratio < 1, F.degrees(F.asin(F.least(ratio, F.lit(1.0))))).otherwise(180.0)
    cells = round(360.0 / size)
    first = F.floor((lon - lon_reach) / size)
    last = F.least(F.floor((lon + lon_reach) / size), first + (cells - 1))
    half = cells // 2
    wrapped = F.pmod(F.col("_raw") + half, F.lit(cells)) - half
    return (
        places.withColumn("_row", F.explode(rows))
        .withColumn("_raw", F.explode(F.sequence(first, last)))
        .withColumn("_col", wrapped)
        .drop("_raw")
    )


def _possible_nearest(members: DataFrame, max_km: float, size: float) -> DataFrame:
    """Drop places that are nearest, within ``max_km``, for no point of the cell.

    Every place is compared with five of its cell: those closest to the middle
    and to the four corners. It goes if one of them is closer at all corners.
    """
    corners, middle = _cell_points(size)
    # Cosines of the distances: larger is closer.
    near = F.array(*[_cosine(*point) for point in (*corners, middle)])
    km = F.acos(F.greatest(F.least(F.col("_near")[4], F.lit(1.0)), F.lit(-1.0))) * EARTH_KM
    # Any point of the cell is reached from its middle by going half a cell along
    # the middle latitude and then half a cell along a meridian, at most.
    row = F.col("_row")
    mid_lat = (row + 0.5) * size
    zero = F.lit(0.0)
    half = haversine_km(mid_lat, zero, mid_lat, F.lit(size / 2)) + size / 2 * KM_PER_DEGREE
    measured = members.withColumn("_near", near).filter(km <= half + max_km + SLACK_KM)
    closest = measured.groupBy("_row", "_col").agg(
        F.array(*[F.max_by("_near", F.col("_near")[at]) for at in range(5)]).alias("_closest")
    )

    def beaten_by(rival: Column) -> Column:
        ahead = [rival[at] > F.col("_near")[at] + SLACK for at in range(4)]
        return ahead[0] & ahead[1] & ahead[2] & ahead[3]

    possible = ~F.exists("_closest", beaten_by)
    rivals = spread_join(measured, closest, ["_row", "_col"], "inner")
    return rivals.filter(possible).select(*members.columns)


def _cell_points(size: float) -> tuple[list[tuple[Column, Column]], tuple[Column, Column]]:
    """Corners and middle of a cell, in radians.

    Great circles between the corners must enclose the cell. They bend towards
    the pole, so the corners on the side of the equator are moved outwards.
    """
    row, step = F.col("_row"), math.radians(size)
    south, north = row * step, (row + 1) * step
    outer_south = F.when(row >= 0, F.atan(F.tan(south) * math.cos(step / 2))).otherwise(south)
    outer_north = F.when(row < 0, F.atan(F.tan(north) * math.cos(step / 2))).otherwise(north)
    west, east = F.col("_col") * step, (F.col("_col") + 1) * step
    corners = [(lat, lon) for lat in (outer_south, outer_north) for lon in (west, east)]
    return corners, ((south + north) / 2, (west + east) / 2)


def _cosine(lat: Column, lon: Column) -> Column:
    """Cosine of the angle between a point, in radians, and the place of a row."""
    own_lat, own_lon = F.radians("latitude"), F.radians("longitude")
    return F.sin(lat) * F.sin(own_lat) + F.cos(lat) * F.cos(own_lat) * F.cos(lon - own_lon)
