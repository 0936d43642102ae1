"""Nearest place against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from placemill import schemas as S
from placemill.operators import attach_place
from placemill.operators.geo import EARTH_KM, _grid_index


def km(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2
    h += math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_KM * math.asin(math.sqrt(min(1.0, h)))


def brute(points, places, max_km):
    best = {}
    for key, *at in points:
        near = [(km(at, (la, lo)), city, state) for city, state, la, lo in places]
        near = [n for n in near if n[0] <= max_km]
        best[key] = min(near)[1:] if near else (None, None)
    return best


def check(spark, points, places, max_km, cell_deg):
    df = spark.createDataFrame(points, "id long, latitude double, longitude double")
    gazetteer = spark.createDataFrame(places, S.GAZETTEER)
    placed = attach_place(df, gazetteer, max_km=max_km, cell_deg=cell_deg).collect()
    assert len(placed) == len(points)
    got = {r.id: (r.ciudad, r.estado) for r in placed}
    assert got == brute(points, places, max_km)
    return got


@pytest.mark.parametrize(
    ("lat", "lon", "max_km", "cell_deg"),
    [
        ((20, 45), (-120, -70), 300, 5.0),
        ((20, 45), (-120, -70), 120, 0.5),
        ((85, 90), (-180, 180), 250, 2.0),
        ((-90, -84), (-180, 180), 250, 0.5),
        ((-5, 5), (170, 190), 200, 1.0),
    ],
)
def test_matches_brute_force(spark, lat, lon, max_km, cell_deg):
    rng = random.Random(7)

    def spot():
        east = rng.uniform(*lon)
        return rng.uniform(*lat), east - 360 if east > 180 else east

    places = [(f"c{n}", f"s{n % 9}", *spot()) for n in range(120)]
    got = check(spark, [(n, *spot()) for n in range(250)], places, max_km, cell_deg)
    assert any(city for city, _ in got.values())


def test_dense_cells_are_cut(spark):
    rng = random.Random(3)
    dense = [("d%03d" % n, "x", 40 + rng.random() / 50, -75 + rng.random() / 50) for n in range(200)]
    sparse = [("far", "y", 40.4, -75.4), ("copy", "z", 40.4, -75.4)]
    points = [(n, 40 + rng.random() / 40, -75 + rng.random() / 40) for n in range(60)]
    points += [(n, 40.3 + rng.random() / 5, -75.5 + rng.random() / 5) for n in range(60, 90)]
    check(spark, points, dense + sparse, 60, 0.5)
    gazetteer = spark.createDataFrame(dense + sparse, S.GAZETTEER)
    levels = _grid_index(gazetteer, 60, 0.5)
    assert len(levels) > 1
    sizes = [level.agg(F.max(F.size("_places"))).first()[0] for level in levels]
    assert all(size is None or size <= 64 for size in sizes)


def test_nothing_near_and_no_coordinates(spark):
    points = [(1, 10.0, 10.0), (2, None, 5.0)]
    df = spark.createDataFrame(points, "id long, latitude double, longitude double")
    gazetteer = spark.createDataFrame([("c", "s", 50.0, 50.0)], S.GAZETTEER)
    rows = attach_place(df, gazetteer, max_km=50).collect()
    assert {(r.id, r.ciudad, r.estado) for r in rows} == {(1, None, None), (2, None, None)}


def test_ties_go_to_the_smaller_name(spark):
    places = [("b", "s", 1.0, 0.0), ("a", "s", -1.0, 0.0), ("z", "s", 1.0, 0.0)]
    check(spark, [(1, 0.0, 0.0), (2, 0.9, 0.0)], places, 200, 1.0)


def test_cell_size_is_checked(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "latitude double, longitude double")
    with pytest.raises(ValueError, match="90"):
        attach_place(df, df, cell_deg=0.7)
