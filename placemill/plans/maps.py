"""Tables built from Maps places and reviews.

Builders take named input tables and return named output tables. Inputs come
from ``sources``; places need the position columns of ``read_many``, because
the first of several rows with one id is kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill import schemas
from placemill.constants import (
    FIRST_YEAR,
    LAST_YEAR,
    MAPS_RESTAURANT,
    NO_DATA,
    PLANNING_KEY,
    PLATFORM_MAPS,
    SERVICE_KEY,
)
from placemill.functions.temporal import from_millis, year_bounds
from placemill.operators.dedupe import dedupe_first, first_rows
from placemill.operators.filters import exclude_values, has_category, in_states, not_null
from placemill.operators.incremental import only_new
from placemill.operators.nested import explode_option
from placemill.operators.states import parse_address
from placemill.sinks.tables import TableSet, conform
from placemill.sources.readers import POSITION

# Child table names, either as loaded or as staged folders.
TABLE_NAMES = ("business", "category_business", "service_business", "planning_busines")
STAGED_NAMES = ("business", "category", "service", "planning")


def _restaurants(
    inputs: Mapping[str, DataFrame],
    *,
    scope: str,
    order_by: Sequence,
    mode: str,
    bad_addresses: Sequence[str],
) -> DataFrame:
    """Restaurants of the kept states, one row per place, with city and state."""
    sites = dedupe_first(inputs["sites"], ["gmap_id"], order_by, scope=scope)
    sites = has_category(not_null(sites, "address", "category"), "category", MAPS_RESTAURANT)
    sites = exclude_values(sites.fillna({"price": NO_DATA}), "address", bad_addresses)
    return in_states(parse_address(sites, inputs["states"], mode=mode), "state")


def build_maps_sites(
    inputs: Mapping[str, DataFrame],
    *,
    scope: str = "file",
    order_by: Sequence = POSITION,
    mode: str = "exact",
    bad_addresses: Sequence[str] = (),
    outer: bool = False,
    names: Sequence[str] = TABLE_NAMES,
) -> TableSet:
    """``sites`` and ``states`` to a business table and its three child tables.

    ``mode`` is the state lookup of ``parse_address``, ``outer`` keeps empty
    option lists as null rows, ``names`` are the four output names.
    """
    parent = _restaurants(
        inputs, scope=scope, order_by=order_by, mode=mode, bad_addresses=bad_addresses
    ).select(
        F.col("gmap_id").alias("business_id"),
        "name",
        "city",
        "state",
        "latitude",
        "longitude",
        F.col("avg_rating").alias("stars"),
        "price",
        F.lit(PLATFORM_MAPS).cast("long").alias("platform"),
        "category",
        F.try_element_at("MISC", F.lit(SERVICE_KEY)).alias("_service"),
        F.try_element_at("MISC", F.lit(PLANNING_KEY)).alias("_planning"),
    )
    category = explode_option(parent, "business_id", "category", "category_name", outer=outer)
    children = [
        category.withColumn("platform", F.lit(PLATFORM_MAPS).cast("long")),
        _options(parent, "_service", "service_option", outer),
        _options(parent, "_planning", "planning_option", outer),
    ]
    business = parent.select(*schemas.BUSINESS.names)
    return TableSet(dict(zip(names, [business, *children])), shared=[parent])


def _options(parent: DataFrame, col: str, out: str, outer: bool) -> DataFrame:
    """Option rows of one group; a place without the group has none."""
    return explode_option(not_null(parent, col), "business_id", col, out, outer=outer)


def build_maps_business(
    inputs: Mapping[str, DataFrame],
    *,
    scope: str = "file",
    order_by: Sequence = POSITION,
    mode: str = "exact",
) -> TableSet:
    """``sites`` and ``states`` to the business table only."""
    tables = build_maps_sites(inputs, scope=scope, order_by=order_by, mode=mode)
    return TableSet({"business": tables["business"]})


def build_maps_restaurants(inputs: Mapping[str, DataFrame]) -> TableSet:
    """``sites`` to the restaurants among them, otherwise as they are."""
    sites = inputs["sites"].drop(*POSITION)
    return TableSet({"restaurants": has_category(sites, "category", MAPS_RESTAURANT)})


def build_maps_slim(inputs: Mapping[str, DataFrame]) -> TableSet:
    """``sites`` with address and category, reduced to seven columns."""
    sites = not_null(inputs["sites"], "address", "category")
    return TableSet({"sitios_gmaps": conform(sites, schemas.SITES_SLIM)})


def build_maps_reviews(inputs: Mapping[str, DataFrame]) -> TableSet:
    """``reviews`` of the kept years to review rows and owner replies.

    The years are tested on the raw milliseconds, which scans can skip by.
    """
    first, after = [
        int((moment - year_bounds(1970, 1970)[0]).total_seconds() * 1000)
        for moment in year_bounds(FIRST_YEAR, LAST_YEAR)
    ]
    dated = inputs["reviews"].filter((F.col("time") >= first) & (F.col("time") < after))
    none = F.lit(0).cast("long")
    reviews = dated.select(
        F.col("gmap_id").alias("business_id"),
        F.col("user_id").cast("string").alias("user_id"),
        from_millis("time").alias("date"),
        F.col("rating").alias("stars"),
        none.alias("useful"),
        none.alias("funny"),
        none.alias("cool"),
        "text",
        F.lit(PLATFORM_MAPS).cast("long").alias("platform"),
    )
    tables = {"reviews": reviews}
    if "resp" in dated.columns:
        tables["resp_reviews"] = not_null(dated, "resp").select(
            F.col("gmap_id").alias("business_id"),
            from_millis("resp.time").alias("time"),
            F.col("resp.text").alias("text"),
        )
    return TableSet(tables)


def build_maps_new_reviews(
    inputs: Mapping[str, DataFrame],
    *,
    per_file: int | None = None,
    order_by: Sequence = POSITION,
    prune: bool = False,
) -> TableSet:
    """``reviews`` that are not in ``target`` yet, compared on all but the text.

    ``per_file`` takes only the first rows of each file. ``prune`` limits the
    scan of the target to the dates of the batch.
    """
    batch = inputs["reviews"]
    if per_file is not None:
        batch = first_rows(batch, [POSITION[0]], order_by, per_file)
    reviews = build_maps_reviews({"reviews": batch})["reviews"]
    new = only_new(reviews, inputs["target"], prune_on="date" if prune else None)
    return TableSet({"reviews": new.select(*schemas.REVIEWS.names)})
