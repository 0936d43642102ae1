"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from placemill.operators import (
    exclude_values,
    has_category,
    has_token,
    in_states,
    not_null,
    not_sentinel,
    only_new,
    parse_address,
    year_between,
)
from suite import inputs
from suite.inputs import with_ctes
from suite.registry import query


@query(
    "f1_drop_nulls",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT source_seq, address, raw_state AS state FROM sites
    WHERE address IS NOT NULL AND category IS NOT NULL""",
    ),
)
def drop_nulls(t):
    kept = not_null(inputs.sites(t), "address", "category")
    return kept.select("source_seq", "address", "state")


@query(
    "f2_has_category",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT source_seq, name FROM sites
    WHERE list_contains(category, 'Restaurant')""",
    ),
)
def category(t):
    return has_category(inputs.sites(t), "category", "Restaurant").select("source_seq", "name")


@query(
    "f3_has_token",
    with_ctes(
        inputs.YELP_SQL,
        body="""SELECT source_seq, categories FROM yelp
    WHERE list_contains(string_split(categories, ','), 'Restaurants')""",
    ),
)
def token(t):
    rows = has_token(inputs.yelp_business(t), "categories", "Restaurants")
    return rows.select("source_seq", "categories")


@query(
    "f3_has_token_trimmed",
    with_ctes(
        inputs.YELP_SQL,
        body="""SELECT source_seq, categories FROM yelp
    WHERE list_contains(list_transform(string_split(categories, ','), lambda x: trim(x)),
      'Restaurants')""",
    ),
)
def token_trimmed(t):
    rows = has_token(inputs.yelp_business(t), "categories", "Restaurants", trim_tokens=True)
    return rows.select("source_seq", "categories")


@query(
    "f4_in_states",
    f"""SELECT c_custkey, {inputs.sql_list(inputs.NAMES)}[c_nationkey + 1] AS state FROM customer
    WHERE {inputs.sql_list(inputs.NAMES)}[c_nationkey + 1] IN {inputs.KEPT}""",
)
def states(t):
    name = F.get(F.array(*map(F.lit, inputs.NAMES)), F.col("c_nationkey"))
    return in_states(t.customer.select("c_custkey", name.alias("state")), "state")


@query(
    "f5_year_between",
    """SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem
    WHERE year(l_shipdate) BETWEEN 1997 AND 1999""",
)
def years(t):
    return year_between(t.lineitem, "l_shipdate", 1997, 1999).select(
        "l_orderkey", "l_partkey", "l_shipdate"
    )


@query(
    "f6_not_sentinel",
    """SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS LONGITUD FROM orders
    WHERE nullif(o_orderpriority, '1-URGENT') IS DISTINCT FROM '5-LOW'""",
)
def sentinel(t):
    longitude = F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("LONGITUD")
    return not_sentinel(t.orders.select("o_orderkey", longitude), "LONGITUD", "5-LOW")


@query(
    "f7_exclude_values",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT source_seq, address FROM sites
    WHERE address IS NULL OR address NOT IN ('Tampa, FL', 'Tampa, NY')""",
    ),
)
def excluded(t):
    sites = inputs.sites(t).select("source_seq", "address")
    return exclude_values(sites, "address", ["Tampa, FL", "Tampa, NY"])


@query(
    "f8_equality_pair",
    with_ctes(
        inputs.FEATURES_SQL,
        body="""SELECT state, category_name, latitude, longitude FROM features
    WHERE state = 'Texas' AND category_name = 'BUILDING'""",
    ),
)
def equality_pair(t):
    chosen = (F.col("state") == "Texas") & (F.col("category_name") == "BUILDING")
    rows = inputs.location_features(t).filter(chosen)
    return rows.select("state", "category_name", "latitude", "longitude")


@query(
    "f9_review_predicate",
    with_ctes(
        inputs.GAME_REVIEWS_SQL,
        body="""SELECT game_id, sentiment AS sentiment_analysis FROM game_reviews
    WHERE (recommend AND sentiment > 0 AND year = 1998)
       OR (NOT recommend AND sentiment = 0 AND year = 1999)""",
    ),
)
def review_predicate(t):
    score, year = F.col("sentiment_analysis"), F.col("year")
    good = F.col("recommend") & (score > 0) & (year == 1998)
    bad = ~F.col("recommend") & (score == 0) & (year == 1999)
    return inputs.game_reviews(t).filter(good | bad).select("game_id", "sentiment_analysis")


@query(
    "f10_lower_case_lookup",
    with_ctes(
        inputs.USER_GENRE_SQL,
        body="""SELECT user_id, release_year, playtime FROM user_genre
    WHERE genres = lower('BRAND#7')""",
    ),
)
def lower_case_lookup(t):
    rows = inputs.user_genre(t).filter(F.col("genres") == "BRAND#7".lower())
    return rows.select("user_id", "release_year", F.col("playtime_forever").alias("playtime"))


@query(
    "f11_not_yet_loaded",
    """SELECT o_orderkey, o_custkey, o_orderpriority AS text FROM orders
    WHERE o_orderstatus <> 'F'""",
)
def not_yet_loaded(t):
    """The target holds the filled orders, with another text."""
    batch = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("text"))
    loaded = t.orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey", F.lit("old").alias("text")
    )
    return only_new(batch, loaded).select("o_orderkey", "o_custkey", "text")


@query(
    "f12_find_by_id",
    "SELECT vec_id + 1000 AS game_id, 'item ' || vec_id AS game_name, vec_id AS idx "
    "FROM embeddings WHERE vec_id + 1000 = 1042",
)
def find_by_id(t):
    return inputs.game_model(t).filter(F.col("game_id") == 1042)


@query(
    "f4_in_states_after_parsing",
    with_ctes(
        inputs.STATES_SQL,
        inputs.SITES_SQL,
        body=f"""SELECT trim(d.nombre_largo) AS state, count(*) AS n
    FROM sites JOIN states d
      ON length(address) > 10 AND len(string_split(address, ',')) > 2
     AND substr(string_split(address, ',')[-1], 2, 2) = d.nombre_corto
    WHERE trim(d.nombre_largo) IN {inputs.KEPT} GROUP BY 1""",
    ),
)
def states_after_parsing(t):
    sites = parse_address(inputs.sites(t).select("address"), inputs.states(t))
    return in_states(sites, "state").groupBy("state").agg(F.count("*").alias("n"))
