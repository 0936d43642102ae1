"""Pipelines on small raw files."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from placemill import plans, sources
from placemill import schemas as S
from placemill.operators import attach_place

STATES = [("Florida ", "FL", "1"), ("Texas ", "TX", "2"), ("Utah ", "UT", "3")]


def values(df, *cols):
    return sorted((tuple(row) for row in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def states(spark):
    return spark.createDataFrame(STATES, S.STATE_DIM).coalesce(1)


def site(gmap_id, address="x, Tampa, FL 33601", category=("Restaurant",), **more):
    row = {"gmap_id": gmap_id, "name": f"n{gmap_id}", "address": address, "avg_rating": 4.5}
    row |= {"category": list(category) if category else None, "state": "Open", "hours": [["a"]]}
    return json.dumps(row | more)


@pytest.fixture(scope="module")
def sites(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sites")
    first = [
        site("1", price="$$", MISC={"Service options": ["Takeout", "Dine-in"], "Crowd": ["x"]}),
        site("1", name="copy"),
        site("2", address=None),
        site("2"),  # its first row has no address, so the place is gone
        site("3", category=None),
        site("4", category=["Thai Restaurant"]),
        site("5", address="x, Provo, UT 84601"),
        site("6", category=["Bar", "Restaurant"], MISC={"Planning": ["Quick visit"]}),
        site("7", MISC={"Service options": []}),
    ]
    second = [site("1", name="other file"), site("8", address="12 Long Road, Tampa, F")]
    (folder / "1.json").write_text("\n".join(first))
    (folder / "2.json").write_text("\n".join(second))
    return sources.read_many(spark, str(folder), "json", S.MAPS_SITES, glob="*.json")


def test_maps_sites(sites, states):
    tables = plans.build_maps_sites({"sites": sites, "states": states})
    for name, df in tables.items():
        assert df.columns == S.OUTPUT_TABLES[name].names
        assert [f.dataType for f in df.schema] == [f.dataType for f in S.OUTPUT_TABLES[name]]
    business = tables["business"]
    assert values(business, "business_id", "name", "price", "city", "state", "platform") == [
        ("1", "n1", "$$", "Tampa", "Florida", 1),
        ("1", "other file", "SIN DATO", "Tampa", "Florida", 1),
        ("6", "n6", "SIN DATO", "Tampa", "Florida", 1),
        ("7", "n7", "SIN DATO", "Tampa", "Florida", 1),
    ]
    assert values(tables["category_business"], "business_id", "category_name") == [
        ("1", "Restaurant"),
        ("1", "Restaurant"),
        ("6", "Bar"),
        ("6", "Restaurant"),
        ("7", "Restaurant"),
    ]
    service = tables["service_business"]
    assert values(service, "business_id", "service_option") == [("1", "Dine-in"), ("1", "Takeout")]
    planning = tables["planning_busines"]
    assert values(planning, "business_id", "planning_option") == [("6", "Quick visit")]


def test_maps_sites_options(sites, states):
    inputs = {"sites": sites, "states": states}
    tables = plans.build_maps_sites(inputs, scope="global", outer=True, mode="contains")
    assert values(tables["business"], "business_id") == [("1",), ("6",), ("7",), ("8",)]
    assert ("7", None) in values(tables["service_business"], "business_id", "service_option")
    bad = plans.build_maps_sites(inputs, bad_addresses=["x, Tampa, FL 33601"])
    assert bad["business"].count() == 0


def test_maps_without_any_planning(spark, states, tmp_path):
    (tmp_path / "a.json").write_text(site("1", MISC={"Crowd": ["x"]}))
    sites = sources.read_many(spark, str(tmp_path), "json", S.MAPS_SITES, glob="*.json")
    tables = plans.build_maps_sites({"sites": sites, "states": states})
    assert tables["business"].count() == 1
    assert tables["planning_busines"].count() == 0


def test_maps_variants(sites, states):
    inputs = {"sites": sites, "states": states}
    assert plans.build_maps_business(inputs)["business"].count() == 4
    restaurants = plans.build_maps_restaurants({"sites": sites})["restaurants"]
    assert restaurants.columns == S.MAPS_SITES.names
    assert restaurants.count() == 9
    slim = plans.build_maps_slim({"sites": sites})["sitios_gmaps"]
    assert slim.schema == S.SITES_SLIM
    assert slim.filter("state = 'Open'").count() == 9


MS_2015 = 1_420_070_400_000


def maps_reviews(spark, rows):
    return spark.createDataFrame(rows, S.MAPS_REVIEWS)


def test_maps_reviews(spark):
    last, after = 1_640_995_199_999, 1_640_995_200_000
    rows = [("g", "123456789012345678901", MS_2015, 5, "hi", (MS_2015 + 1000, "thanks"))]
    rows += [("g", "2", 1_262_303_999_999, 1, "early", None), ("g", "3", last, 1, None, None)]
    rows += [("g", "4", after, 1, "late", (after, "no")), ("g", "5", None, 1, "none", None)]
    tables = plans.build_maps_reviews({"reviews": maps_reviews(spark, rows)})
    reviews = tables["reviews"]
    assert reviews.columns == S.REVIEWS.names
    assert [f.dataType for f in reviews.schema] == [f.dataType for f in S.REVIEWS]
    assert values(reviews, "user_id", "date", "stars", "useful", "platform") == [
        ("123456789012345678901", datetime(2015, 1, 1), 5, 0, 1),
        ("3", datetime(2021, 12, 31, 23, 59, 59, 999000), 1, 0, 1),
    ]
    assert values(tables["resp_reviews"], "business_id", "time", "text") == [
        ("g", datetime(2015, 1, 1, 0, 0, 1), "thanks")
    ]


def test_new_reviews_per_file(spark, tmp_path):
    for name in ("1", "2"):
        lines = [
            json.dumps({"gmap_id": name, "user_id": f"{n}", "time": MS_2015, "rating": n})
            for n in range(9)
        ]
        (tmp_path / f"{name}.json").write_text("\n".join(lines))
    batch = sources.read_many(spark, str(tmp_path), "json", S.MAPS_REVIEWS, glob="*.json")
    empty = spark.createDataFrame([], S.REVIEWS)
    new = plans.build_maps_new_reviews({"reviews": batch, "target": empty}, per_file=5)["reviews"]
    firsts = [(b, f"{n}") for b in ("1", "2") for n in range(5)]
    assert values(new, "business_id", "user_id") == firsts
    known = {"reviews": batch, "target": new.filter("business_id = '1'")}
    for prune in (False, True):
        rest = plans.build_maps_new_reviews(known, per_file=5, prune=prune)["reviews"]
        assert values(rest, "business_id", "user_id") == firsts[5:]


def yelp_business(spark):
    def row(key, categories="Restaurants, Bars", state="FL", attributes=None, **_):
        return (key, f"n{key}", "City", state, 1.0, 2.0, 3.5, categories, attributes)

    rows = [
        row("1", attributes={"HasTV": "True", "Other": "x"}, state=" FL\t"),
        row("2", categories="Bars, Restaurants"),
        row("3", state="QC"),
        row("4", state=None),
        row("5", categories=None),
        row("6", state="UT"),
    ]
    return spark.createDataFrame(rows, S.YELP_BUSINESS)


def test_yelp_business(spark, states):
    raw = yelp_business(spark)
    raw = raw.unionByName(raw.filter("business_id = '1'"))
    inputs = {"business": raw, "states": states}
    options = {"order_by": ["name"], "scope": "global"}
    tables = plans.build_yelp_business(inputs, **options)
    assert values(tables["business"], "business_id", "state", "price", "platform") == [
        ("1", "Florida", "SIN DATO", 2)
    ]
    assert values(tables["category_business"], "category_name", "platform") == [
        ("Bars", 2),
        ("Restaurants", 2),
    ]
    attributes = tables["attributes_business"]
    assert attributes.columns == S.ATTRIBUTES_BUSINESS.names
    assert values(attributes, "business_id", "HasTV", "GoodForKids") == [("1", "True", "None")]
    trimmed = plans.build_yelp_business(inputs, trim_tokens=True, **options)
    assert values(trimmed["business"], "business_id") == [("1",), ("2",)]


def test_yelp_business_placed(spark):
    placed = yelp_business(spark).selectExpr("*", "'Miami' AS ciudad", "'Florida ' AS estado")
    placed = placed.unionByName(placed)
    tables = plans.build_yelp_business_placed({"business": placed})
    business = tables["business"]
    assert business.columns == S.BUSINESS.names
    kept = [(k, "Miami", "Florida") for k in ("1", "2", "3", "4", "6") for _ in range(2)]
    assert values(business, "business_id", "city", "state") == kept


def test_yelp_reviews(spark, states):
    def review(key, business, year):
        return (key, business, "u", datetime(year, 5, 5), 4, 1, 2, 3, "t")

    rows = [review("a", "1", 2015), review("b", "2", 2015), review("c", "1", 2022)]
    rows += [review("d", "3", 2015), review("e", None, 2015)]
    inputs = {
        "business": yelp_business(spark),
        "states": states,
        "reviews": spark.createDataFrame(rows, S.YELP_REVIEWS),
    }
    tables = plans.build_yelp_reviews(inputs, order_by=["name"], scope="global")
    assert tables["reviews"].columns == S.REVIEWS.names
    assert values(tables["reviews"], "business_id", "date", "platform") == [
        ("1", datetime(2015, 5, 5), 2)
    ]


def test_tips_users_and_homicides(spark):
    tips = [("b", "u", datetime(2012, 1, 1), "t", 0), ("b", "v", datetime(2009, 1, 1), "t", 0)]
    made = plans.build_yelp_tips({"tips": spark.createDataFrame(tips, S.YELP_TIPS)})["tips_yelp"]
    assert values(made, "user_id") == [("u",)]
    assert made.schema == S.TIPS

    schema = S.table(**{f.name: f.dataType for f in S.USERS} | {"yelping_since": S.STR})
    users = [("u", name, 1, "2010-02-03 04:05:06", 0, 0, 0, 0, 4.0) for name in ("b", "a")]
    raw = {"users": spark.createDataFrame(users, schema)}
    made = plans.build_yelp_users(raw, order_by=["name"], scope="global")["users_yelp"]
    assert values(made, "name", "yelping_since") == [("a", datetime(2010, 2, 3, 4, 5, 6))]

    longitudes = ["-58.4", "SIN DATO", None]
    facts = [(f"h{n}", "2016-03-04", 7, at, "-34", *"xxxxxx") for n, at in enumerate(longitudes)]
    raw = {"homicides": spark.createDataFrame(facts, S.HOMICIDES)}
    made = plans.build_homicides(raw)["hechos_homicidios"]
    assert made.schema == S.HOMICIDE_FACTS
    assert values(made, "Id_hecho", "FECHA") == [
        ("h0", datetime(2016, 3, 4).date()),
        ("h2", datetime(2016, 3, 4).date()),
    ]
    with pytest.raises(ValueError, match="HORA"):
        plans.build_homicides({"homicides": raw["homicides"].drop("HORA")})


def test_locations_page(spark):
    rows = [(f"b{n}", 30.0 + n, -80.0) for n in range(6)]
    business = spark.createDataFrame(rows, "business_id string, latitude double, longitude double")
    places = [(f"c{n}", "s", 30.0 + n, -80.1) for n in range(6)]
    gazetteer = spark.createDataFrame(places, S.GAZETTEER)
    inputs = {"business": business, "gazetteer": gazetteer}
    page = plans.build_locations(inputs, page=(1, 3))["business"]
    assert values(page, "business_id", "ciudad") == [("b1", "c1"), ("b2", "c2")]
    done = attach_place(business.limit(1), gazetteer).drop("longitude")
    both = plans.build_locations({**inputs, "done": done}, page=(4, 9))["business"]
    assert values(both, "ciudad") == [("c0",), ("c4",), ("c5",)]


def test_state_dimension(states):
    made = plans.build_state_dimension({"states": states})["estados_usa2"]
    assert values(made, "nombre_largo") == [("Florida ",), ("Texas ",), ("Utah ",)]
