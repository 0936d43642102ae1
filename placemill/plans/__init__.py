"""Whole-table plans: catalogue questions, recommendation and table builders."""

from placemill.plans.catalogue import (
    best_year,
    canonical_genre,
    neighbours,
    playtime_by_genre_year,
    sentiment_counts,
    similar_items,
    top_items,
    top_user,
)
from placemill.plans.homicides import build_homicides
from placemill.plans.locations import build_locations, build_state_dimension, location_pages
from placemill.plans.maps import (
    build_maps_business,
    build_maps_new_reviews,
    build_maps_restaurants,
    build_maps_reviews,
    build_maps_sites,
    build_maps_slim,
)
from placemill.plans.playtime import add_playtime, compact_playtime, kept_playtime
from placemill.plans.recommend import cluster, recommend_locations, standardise
from placemill.plans.rounds import cluster_rounds
from placemill.plans.yelp import (
    build_yelp_business,
    build_yelp_business_placed,
    build_yelp_reviews,
    build_yelp_tips,
    build_yelp_users,
)

__all__ = [
    "add_playtime",
    "best_year",
    "build_homicides",
    "build_locations",
    "build_maps_business",
    "build_maps_new_reviews",
    "build_maps_restaurants",
    "build_maps_reviews",
    "build_maps_sites",
    "build_maps_slim",
    "build_state_dimension",
    "build_yelp_business",
    "build_yelp_business_placed",
    "build_yelp_reviews",
    "build_yelp_tips",
    "build_yelp_users",
    "canonical_genre",
    "cluster",
    "cluster_rounds",
    "compact_playtime",
    "kept_playtime",
    "location_pages",
    "neighbours",
    "playtime_by_genre_year",
    "recommend_locations",
    "sentiment_counts",
    "similar_items",
    "standardise",
    "top_items",
    "top_user",
]
