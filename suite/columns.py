"""Projections, scalar expressions, null handling and nested data."""

from __future__ import annotations

from pyspark.sql import functions as F

from placemill.constants import ATTRIBUTE_KEYS
from placemill.functions import contains_token, from_millis, parse_timestamp, split_list, strip_ws
from placemill.operators import (
    dedupe_column_names,
    drop_strict,
    explode_option,
    fill_nulls,
    map_columns,
    open_map_columns,
    parse_address,
)
from suite import inputs
from suite.inputs import with_ctes
from suite.registry import query


@query(
    "p1_drop_columns",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem",
)
def drop_columns(t):
    return drop_strict(
        t.lineitem,
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )


@query("p2_select_columns", "SELECT p_brand, p_name, p_partkey FROM part")
def select_columns(t):
    return t.part.select("p_brand", "p_name", "p_partkey")


@query(
    "p3_rename_columns",
    """SELECT c_custkey AS business_id, c_name AS name, c_nationkey, c_acctbal AS stars,
      c_mktsegment FROM customer""",
)
def rename_columns(t):
    return t.customer.withColumnsRenamed(
        {"c_custkey": "business_id", "c_name": "name", "c_acctbal": "stars"}
    )


@query(
    "p4_literal_columns",
    """SELECT event_id, 0::BIGINT AS useful, 0::BIGINT AS funny, 0::BIGINT AS cool,
      1::BIGINT AS platform, 'SIN DATO' AS price FROM events""",
)
def literal_columns(t):
    zero = F.lit(0).cast("long")
    return t.events.select("event_id").withColumns(
        {
            "useful": zero,
            "funny": zero,
            "cool": zero,
            "platform": F.lit(1).cast("long"),
            "price": F.lit("SIN DATO"),
        }
    )


@query("p5_first_of_duplicate_names", "SELECT s_suppkey, s_name FROM supplier")
def first_of_duplicate_names(t):
    twice = t.supplier.select("s_suppkey", "s_name", F.col("s_acctbal").alias("s_name"))
    return dedupe_column_names(twice)


@query(
    "p6_struct_field",
    """SELECT o_orderkey, o_orderstatus AS ciudad, o_orderpriority AS estado FROM orders""",
)
def struct_field(t):
    place = F.struct(F.col("o_orderstatus").alias("city"), F.col("o_orderpriority").alias("state"))
    nested = t.orders.select("o_orderkey", place.alias("place"))
    return nested.select(
        "o_orderkey", F.col("place.city").alias("ciudad"), F.col("place.state").alias("estado")
    )


@query(
    "p7_side_by_side",
    with_ctes(
        inputs.FEATURES_SQL,
        body="""SELECT latitude, longitude, business_stars, review_stars FROM features""",
    ),
)
def side_by_side(t):
    """Coordinates next to other features: both sides come from the same rows."""
    places, other = ["latitude", "longitude"], ["business_stars", "review_stars"]
    return inputs.location_features(t).select(*places, *other)


# ---- scalar expressions ---------------------------------------------------------------


@query(
    "x1_strip",
    "SELECT doc_id, md5(trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' ')) AS stripped "
    "FROM documents",
)
def strip(t):
    padded = F.concat(F.lit(" \t\r\n"), "text", F.lit("\x0b\x0c "))
    return t.documents.select("doc_id", F.md5(strip_ws(padded)).alias("stripped"))


@query("x2_split", "SELECT doc_id, len(string_split(text, ','))::INTEGER AS parts FROM documents")
def split(t):
    return t.documents.select("doc_id", F.size(split_list("text")).alias("parts"))


@query(
    "x3_membership",
    "SELECT p_partkey, list_contains(string_split(p_name, ' '), 'ring') AS is_ring FROM part",
)
def membership(t):
    return t.part.select("p_partkey", contains_token("p_name", "ring", sep=" ").alias("is_ring"))


@query(
    "x4_parse_address",
    with_ctes(
        inputs.STATES_SQL,
        inputs.SITES_SQL,
        body="""SELECT source_seq, address,
      CASE WHEN d.nombre_largo IS NULL THEN 'SIN DATO'
           ELSE trim(string_split(address, ',')[-2]) END AS city,
      coalesce(trim(d.nombre_largo), 'SIN DATO') AS state
    FROM sites LEFT JOIN states d
      ON length(address) > 10 AND len(string_split(address, ',')) > 2
     AND substr(string_split(address, ',')[-1], 2, 2) = d.nombre_corto""",
    ),
)
def parse_addresses(t):
    sites = inputs.sites(t).select("source_seq", "address")
    return parse_address(sites, inputs.states(t))


@query(
    "x5_parse_address_containing",
    with_ctes(
        inputs.STATES_SQL,
        inputs.SITES_SQL,
        """coded AS (
      SELECT source_seq, address, CASE
        WHEN length(address) > 10 AND len(string_split(address, ',')) > 2
        THEN substr(string_split(address, ',')[-1], 2, 2) END AS code FROM sites),
    hit AS (
      SELECT code, arg_min(nombre_largo, pos) AS found
      FROM (SELECT DISTINCT code FROM coded) JOIN states ON contains(nombre_corto, code)
      GROUP BY code)""",
        body="""SELECT source_seq, address,
      CASE WHEN found IS NULL THEN 'SIN DATO'
           ELSE trim(string_split(address, ',')[-2]) END AS city,
      coalesce(trim(found), 'SIN DATO') AS state
    FROM coded LEFT JOIN hit USING (code)""",
    ),
)
def parse_addresses_containing(t):
    sites = inputs.sites(t).select("source_seq", "address")
    return parse_address(sites, inputs.states(t), mode="contains", order_by="pos")


@query("x6_millis_to_timestamp", "SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS date FROM events")
def millis_to_timestamp(t):
    time = inputs.millis(F.col("ts"))
    return t.events.select("event_id", from_millis(time).alias("date"))


@query(
    "x7_text_to_timestamp",
    "SELECT o_orderkey, o_orderdate AS at, o_orderdate::DATE AS day FROM orders",
)
def text_to_timestamp(t):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    parsed = t.orders.select("o_orderkey", parse_timestamp(text).alias("at"))
    return parsed.withColumn("day", F.to_date("at"))


@query("x8_year", "SELECT o_orderkey, year(o_orderdate)::INTEGER AS year FROM orders")
def year(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))


@query(
    "x9_long_ids",
    with_ctes(inputs.MAPS_REVIEWS_SQL, body="SELECT user_id, business_id FROM maps_reviews"),
)
def long_ids(t):
    reviews = inputs.maps_reviews(t)
    return reviews.select(
        F.col("user_id").cast("string").alias("user_id"), F.col("gmap_id").alias("business_id")
    )


@query("x11_lower_case", "SELECT p_partkey, lower(p_brand) AS genre FROM part")
def lower_case(t):
    return t.part.select("p_partkey", F.lower("p_brand").alias("genre"))


@query(
    "x12_to_integer",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, trunc(l_quantity)::BIGINT AS hours,
      trunc(l_extendedprice)::BIGINT AS price FROM lineitem""",
)
def to_integer(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("long").alias("hours"),
        F.col("l_extendedprice").cast("long").alias("price"),
    )


@query(
    "x13_path_text",
    """SELECT page_id, regexp_replace(url, '/[^/]*$', '/*.csv') AS glob,
      'out/' || page_id || '.csv' AS target, url LIKE '%top' AS at_top FROM pages""",
)
def path_text(t):
    return t.pages.select(
        "page_id",
        F.regexp_replace("url", "/[^/]*$", "/*.csv").alias("glob"),
        F.concat(F.lit("out/"), F.col("page_id").cast("string"), F.lit(".csv")).alias("target"),
        F.col("url").endswith("top").alias("at_top"),
    )


# ---- nulls and nested data ------------------------------------------------------------


@query(
    "n1_fill_columns",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT source_seq, address, coalesce(price, 'SIN DATO') AS price,
      coalesce(raw_state, 'SIN DATO') AS state FROM sites""",
    ),
)
def fill_columns(t):
    sites = inputs.sites(t).select("source_seq", "address", "price", "state")
    return fill_nulls(sites, {"price": "SIN DATO", "state": "SIN DATO"})


@query(
    "n2_fill_frame",
    with_ctes(
        inputs.YELP_SQL,
        body="""SELECT source_seq, coalesce(has_tv, 'None') AS "HasTV",
      coalesce(take_out, 'None') AS "RestaurantsTakeOut" FROM yelp""",
    ),
)
def fill_frame(t):
    business = inputs.yelp_business(t).select("source_seq", "attributes")
    return map_columns(business, "attributes", ["HasTV", "RestaurantsTakeOut"]).fillna("None")


@query(
    "g1_explode",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT source_seq, unnest(category) AS category_name FROM sites""",
    ),
)
def explode(t):
    return explode_option(inputs.sites(t), "source_seq", "category", "category_name")


@query(
    "g1_explode_outer",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT source_seq, unnest(CASE WHEN len(service) > 0 THEN service
        ELSE [NULL]::VARCHAR[] END) AS service_option FROM sites""",
    ),
)
def explode_outer(t):
    service = F.try_element_at("MISC", F.lit("Service options"))
    return explode_option(inputs.sites(t), "source_seq", service, "service_option", outer=True)


@query(
    "g2_explode_and_strip",
    with_ctes(
        inputs.YELP_SQL,
        body="""SELECT source_seq, trim(unnest(string_split(categories, ','))) AS category_name
    FROM yelp WHERE categories IS NOT NULL""",
    ),
)
def explode_and_strip(t):
    items = split_list("categories")
    rows = explode_option(inputs.yelp_business(t), "source_seq", items, "category_name")
    return rows.dropna(subset=["category_name"]).withColumn(
        "category_name", strip_ws("category_name")
    )


@query(
    "g3_map_to_columns",
    """SELECT event_id, json_extract_string(props, '$.k') AS k,
      json_extract_string(props, '$.absent') AS absent FROM events""",
)
def map_to_columns(t):
    events = t.events.select("event_id", F.from_json("props", "map<string,string>").alias("props"))
    return map_columns(events, "props", ["k", "absent"])


@query(
    "g3_found_keys",
    with_ctes(
        inputs.YELP_SQL,
        body="""SELECT source_seq, has_tv AS "HasTV", take_out AS "RestaurantsTakeOut" FROM yelp""",
    ),
)
def found_keys(t):
    """Columns for all keys that the maps turn out to have."""
    business = inputs.yelp_business(t).select("source_seq", "attributes")
    return open_map_columns(business, "attributes")


@query(
    "g4_reply_columns",
    with_ctes(
        inputs.MAPS_REVIEWS_SQL,
        body="""SELECT user_id, date + INTERVAL 60 SECOND AS time, text FROM maps_reviews
    WHERE event_type = 'purchase'""",
    ),
)
def reply_columns(t):
    replies = inputs.maps_reviews(t).dropna(subset=["resp"]).select("user_id", "resp.*")
    return replies.withColumn("time", from_millis("time"))


@query(
    "g5_open_keys",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT source_seq, unnest(planning) AS planning_option FROM sites""",
    ),
)
def open_keys(t):
    """A key that only some rows have."""
    misc = map_columns(inputs.sites(t), "MISC", ["Planning"])
    return explode_option(misc, "source_seq", "Planning", "planning_option")


@query(
    "g6_attribute_columns",
    with_ctes(
        inputs.YELP_SQL,
        body="SELECT source_seq, "
        + ", ".join(
            f"""coalesce({ {"HasTV": "has_tv", "RestaurantsTakeOut": "take_out"}.get(k, "NULL") },
        'None') AS "{k}\""""
            for k in ATTRIBUTE_KEYS
        )
        + " FROM yelp",
    ),
)
def attribute_columns(t):
    business = inputs.yelp_business(t).select("source_seq", "attributes")
    return map_columns(business, "attributes", ATTRIBUTE_KEYS, "None")


