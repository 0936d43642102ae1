"""Tables built from Yelp businesses, reviews, tips and users."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill import schemas
from placemill.constants import (
    ATTRIBUTE_KEYS,
    NO_ATTRIBUTE,
    NO_DATA,
    PLATFORM_YELP,
    YELP_RESTAURANT,
)
from placemill.functions.temporal import parse_timestamp
from placemill.functions.text import split_list, strip_ws
from placemill.operators.columns import dedupe_column_names
from placemill.operators.dedupe import dedupe_first
from placemill.operators.filters import has_token, in_states, not_null, year_between
from placemill.operators.incremental import restrict_to
from placemill.operators.nested import explode_option, map_columns
from placemill.operators.states import attach_state
from placemill.sinks.tables import TableSet
from placemill.sources.readers import POSITION


def _restaurants(
    inputs: Mapping[str, DataFrame], order_by: Sequence, scope: str, trim_tokens: bool
) -> DataFrame:
    """Restaurants of the kept states; ``estado`` is the long state name."""
    business = dedupe_column_names(inputs["business"])
    business = dedupe_first(business, ["business_id"], order_by, scope=scope)
    business = has_token(business, "categories", YELP_RESTAURANT, trim_tokens=trim_tokens)
    business = not_null(business, "state").withColumn("state", strip_ws("state"))
    return in_states(attach_state(business, inputs["states"], "state"), "estado")


def _business_tables(kept: DataFrame, city: str, state: str) -> TableSet:
    parent = kept.select(
        "business_id",
        "name",
        F.col(city).alias("city"),
        F.col(state).alias("state"),
        "latitude",
        "longitude",
        "stars",
        F.lit(NO_DATA).alias("price"),
        F.lit(PLATFORM_YELP).cast("long").alias("platform"),
        "categories",
        "attributes",
    )
    items = split_list("categories")
    category = explode_option(parent, "business_id", items, "category_name")
    category = not_null(category, "category_name").select(
        "business_id", strip_ws("category_name").alias("category_name")
    )
    attributes = map_columns(
        parent.select("business_id", "attributes"), "attributes", ATTRIBUTE_KEYS, NO_ATTRIBUTE
    )
    return TableSet(
        {
            "business": parent.select(*schemas.BUSINESS.names),
            "category_business": category.withColumn(
                "platform", F.lit(PLATFORM_YELP).cast("long")
            ),
            "attributes_business": attributes,
        },
        shared=[parent],
    )


def build_yelp_business(
    inputs: Mapping[str, DataFrame],
    *,
    order_by: Sequence = POSITION,
    scope: str = "file",
    trim_tokens: bool = False,
) -> TableSet:
    """``business`` and ``states`` to restaurants, their categories and attributes."""
    return _business_tables(_restaurants(inputs, order_by, scope, trim_tokens), "city", "estado")


def build_yelp_business_placed(inputs: Mapping[str, DataFrame]) -> TableSet:
    """The same tables from ``business`` with corrected ``ciudad`` and ``estado``.

    This variant neither deduplicates nor keeps restaurants only.
    """
    business = not_null(inputs["business"], "categories")
    placed = in_states(business.withColumn("estado", strip_ws("estado")), "estado")
    return _business_tables(placed, "ciudad", "estado")


def build_yelp_reviews(
    inputs: Mapping[str, DataFrame],
    *,
    order_by: Sequence = POSITION,
    scope: str = "file",
    trim_tokens: bool = False,
) -> TableSet:
    """``reviews`` of the restaurants in ``business``, in the kept years."""
    kept = _restaurants(inputs, order_by, scope, trim_tokens).select("business_id")
    reviews = restrict_to(year_between(inputs["reviews"], "date"), kept, "business_id")
    reviews = reviews.withColumn("platform", F.lit(PLATFORM_YELP).cast("long"))
    return TableSet({"reviews": reviews.select(*schemas.REVIEWS.names)})


def build_yelp_tips(inputs: Mapping[str, DataFrame]) -> TableSet:
    """``tips`` of the kept years."""
    tips = year_between(inputs["tips"], "date")
    return TableSet({"tips_yelp": tips.select(*schemas.TIPS.names)})


def build_yelp_users(
    inputs: Mapping[str, DataFrame], *, order_by: Sequence = POSITION, scope: str = "file"
) -> TableSet:
    """One row per user in ``users``, with the sign-up time parsed."""
    users = dedupe_first(inputs["users"], ["user_id"], order_by, scope=scope)
    users = users.withColumn("yelping_since", parse_timestamp("yelping_since"))
    return TableSet({"users_yelp": users.select(*schemas.USERS.names)})
