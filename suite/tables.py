"""Output tables built from raw inputs, end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from placemill import plans, sinks, sources
from placemill import schemas as S
from placemill.operators import row_range
from placemill.plans.maps import STAGED_NAMES, TABLE_NAMES
from placemill.runtime import scratch_path
from suite import inputs
from suite.inputs import BUSINESS_FROM_KEPT, with_ctes
from suite.registry import query

KEPT_SITES = (inputs.STATES_SQL, inputs.SITES_SQL, inputs.kept_sites_sql())
KEPT_YELP = (inputs.STATES_SQL, inputs.YELP_SQL, inputs.KEPT_YELP_SQL)


def _maps(t):
    return {"sites": inputs.sites(t), "states": inputs.states(t)}


def _yelp(t):
    return {"business": inputs.yelp_business(t), "states": inputs.states(t)}


@query("l1_maps_business", with_ctes(*KEPT_SITES, body=BUSINESS_FROM_KEPT))
def maps_business(t):
    return plans.build_maps_sites(_maps(t))["business"]


@query(
    "l1_maps_categories",
    with_ctes(
        *KEPT_SITES,
        body="""SELECT gmap_id AS business_id, unnest(category) AS category_name,
      1::BIGINT AS platform FROM kept""",
    ),
)
def maps_categories(t):
    return plans.build_maps_sites(_maps(t))["category_business"]


@query(
    "l1_maps_services",
    with_ctes(
        *KEPT_SITES,
        body="SELECT gmap_id AS business_id, unnest(service) AS service_option FROM kept",
    ),
)
def maps_services(t):
    return plans.build_maps_sites(_maps(t))["service_business"]


@query(
    "l1_maps_planning",
    with_ctes(
        *KEPT_SITES,
        body="SELECT gmap_id AS business_id, unnest(planning) AS planning_option FROM kept",
    ),
)
def maps_planning(t):
    return plans.build_maps_sites(_maps(t))["planning_busines"]


@query(
    "l2_maps_loaded",
    with_ctes(
        inputs.STATES_SQL,
        inputs.SITES_SQL,
        inputs.kept_sites_sql("gmap_id"),
        body=BUSINESS_FROM_KEPT,
    ),
)
def maps_loaded(t):
    """One row per place over all files, loaded through the connector sink."""
    path = scratch_path(t.spark, "l2")
    order = ["source_file", "source_seq"]
    tables = plans.build_maps_sites(_maps(t), scope="global", order_by=order)
    sinks.write_all(tables, lambda name, df: sinks.save(df, f"{path}/{name}"))
    return sources.read_parquet(t.spark, f"{path}/business", schema=S.BUSINESS)


@query(
    "l3_maps_staged",
    with_ctes(
        *KEPT_SITES,
        body="""SELECT gmap_id AS business_id, unnest(category) AS category_name,
      1::BIGINT AS platform FROM kept""",
    ),
)
def maps_staged(t):
    """JSON files per source, staged as CSV, then loaded."""
    raw, staged = scratch_path(t.spark, "l3-raw"), scratch_path(t.spark, "l3-staged")
    # A folder per source; sorted, so that file order is the order of the input.
    sites = inputs.sites(t).withColumn("source", F.col("source_file"))
    sites.repartitionByRange("source").sortWithinPartitions("source", "source_seq").select(
        *S.MAPS_SITES.names, "source"
    ).write.partitionBy("source").json(raw)
    read = sources.read_many(t.spark, raw, "json", S.MAPS_SITES, glob="*.json")
    tables = plans.build_maps_sites(
        {"sites": read, "states": inputs.states(t)}, names=STAGED_NAMES
    )
    sinks.write_all(tables, lambda name, df: sinks.write_csv(df, f"{staged}/{name}"))
    loaded = scratch_path(t.spark, "l3-loaded")
    category = sources.read_many(
        t.spark,
        f"{staged}/category",
        "csv",
        S.CATEGORY_BUSINESS,
        glob="*.csv",
        with_file=False,
        header="true",
    )
    sinks.save(category, loaded)
    return sources.read_parquet(t.spark, loaded)


ALL_MAPS_ROWS = with_ctes(
    *KEPT_SITES,
    body=f"""SELECT 'business' AS name, business_id, concat_ws('|', name, city, state, price) AS value
    FROM ({BUSINESS_FROM_KEPT})
    UNION ALL SELECT 'category', gmap_id, unnest(category) FROM kept
    UNION ALL SELECT 'service', gmap_id, unnest(service) FROM kept
    UNION ALL SELECT 'planning', gmap_id, unnest(planning) FROM kept""",
)


def _rows(name, df, value):
    return df.select(F.lit(name).alias("name"), "business_id", value.alias("value"))


def _all_rows(business, category, service, planning):
    """The four tables under one another."""
    line = F.concat_ws("|", "name", "city", "state", "price")
    return (
        _rows("business", business, line)
        .unionAll(_rows("category", category, F.col("category_name")))
        .unionAll(_rows("service", service, F.col("service_option")))
        .unionAll(_rows("planning", planning, F.col("planning_option")))
    )


@query("l3_maps_staged_tables", ALL_MAPS_ROWS)
def maps_staged_tables(t):
    """All four tables staged as CSV, then each loaded from its stage, once though run twice."""
    staged, loaded = scratch_path(t.spark, "l3t-staged"), scratch_path(t.spark, "l3t-loaded")
    tables = plans.build_maps_sites(_maps(t), names=STAGED_NAMES)
    sinks.write_all(tables, lambda name, df: sinks.write_csv(df, f"{staged}/{name}"))
    found = []
    for name, target in zip(STAGED_NAMES, TABLE_NAMES, strict=True):
        schema = S.OUTPUT_TABLES[target]
        for _ in range(2):
            rows = sources.read_many(
                t.spark, f"{staged}/{name}", "csv", schema, glob="*.csv", with_file=False, header="true"
            )
            sinks.load_once(rows, f"{loaded}/{target}", schema, "first")
        found.append(sinks.read_loads(t.spark, f"{loaded}/{target}", schema))
    return _all_rows(*found)


@query("k7_many_tables_rows", ALL_MAPS_ROWS)
def many_tables_rows(t):
    path = scratch_path(t.spark, "k7r")
    tables = plans.build_maps_sites(_maps(t))
    sinks.write_all(tables, lambda name, df: df.write.parquet(f"{path}/{name}"))
    return _all_rows(*[sources.read_parquet(t.spark, f"{path}/{name}") for name in TABLE_NAMES])


@query("l3b_maps_business_only", with_ctes(*KEPT_SITES, body=BUSINESS_FROM_KEPT))
def maps_business_only(t):
    tables = plans.build_maps_business(_maps(t), mode="contains")
    path = sinks.write_csv(tables["business"], scratch_path(t.spark, "l3b"), run_id="1")
    return sources.read_delimited(t.spark, path, S.BUSINESS)


@query(
    "l3c_maps_restaurants",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT gmap_id, name, address, latitude, longitude, price
    FROM sites WHERE list_contains(category, 'Restaurant')""",
    ),
)
def maps_restaurants(t):
    kept = plans.build_maps_restaurants({"sites": inputs.sites(t)})["restaurants"]
    return kept.select("gmap_id", "name", "address", "latitude", "longitude", "price")


@query(
    "l3d_maps_slim",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT gmap_id, name, latitude, longitude, avg_rating, price, raw_state AS state
    FROM sites WHERE address IS NOT NULL AND category IS NOT NULL""",
    ),
)
def maps_slim(t):
    return plans.build_maps_slim({"sites": inputs.sites(t)})["sitios_gmaps"]


YELP_BUSINESS_COLUMNS = """latitude, longitude, stars, 'SIN DATO' AS price,
  2::BIGINT AS platform"""


@query(
    "l4_yelp_business",
    with_ctes(
        *KEPT_YELP,
        body=f"SELECT business_id, name, city, state, {YELP_BUSINESS_COLUMNS} FROM kept",
    ),
)
def yelp_business(t):
    order = ["source_seq"]
    return plans.build_yelp_business(_yelp(t), order_by=order, scope="global")["business"]


@query(
    "l4_yelp_categories",
    with_ctes(
        *KEPT_YELP,
        body="""SELECT business_id, trim(unnest(string_split(categories, ','))) AS category_name,
      2::BIGINT AS platform FROM kept""",
    ),
)
def yelp_categories(t):
    order = ["source_seq"]
    return plans.build_yelp_business(_yelp(t), order_by=order, scope="global")["category_business"]


def _attributes_sql() -> str:
    known = {"HasTV": "has_tv", "RestaurantsTakeOut": "take_out"}
    names = S.ATTRIBUTES_BUSINESS.names[1:]
    columns = [f"""coalesce({known.get(k, "NULL")}, 'None') AS "{k}" """ for k in names]
    return f"SELECT business_id, {', '.join(columns)} FROM kept"


@query("l4_yelp_attributes", with_ctes(*KEPT_YELP, body=_attributes_sql()))
def yelp_attributes(t):
    tables = plans.build_yelp_business(_yelp(t), order_by=["source_seq"], scope="global")
    return tables["attributes_business"]


PLACED = f"""kept AS (SELECT * FROM yelp WHERE categories IS NOT NULL AND estado IN {inputs.KEPT})"""


@query(
    "l5_yelp_business_placed",
    with_ctes(
        inputs.YELP_SQL,
        PLACED,
        body=f"""SELECT business_id, name, ciudad AS city, estado AS state,
      {YELP_BUSINESS_COLUMNS} FROM kept""",
    ),
)
def yelp_business_placed(t):
    business = {"business": inputs.yelp_business(t)}
    return plans.build_yelp_business_placed(business)["business"]


@query("l5_yelp_attributes_placed", with_ctes(inputs.YELP_SQL, PLACED, body=_attributes_sql()))
def yelp_attributes_placed(t):
    business = {"business": inputs.yelp_business(t)}
    return plans.build_yelp_business_placed(business)["attributes_business"]


@query(
    "l5_yelp_categories_placed",
    with_ctes(
        inputs.YELP_SQL,
        PLACED,
        body="""SELECT business_id, trim(unnest(string_split(categories, ','))) AS category_name,
      2::BIGINT AS platform FROM kept""",
    ),
)
def yelp_categories_placed(t):
    business = {"business": inputs.yelp_business(t)}
    return plans.build_yelp_business_placed(business)["category_business"]


MAPS_REVIEWS_RESULT = with_ctes(
    inputs.MAPS_REVIEWS_SQL,
    body="""SELECT business_id, user_id, date, stars, useful, funny, cool, text, platform
    FROM dated""",
)
REPLIES_RESULT = with_ctes(
    inputs.MAPS_REVIEWS_SQL,
    body="""SELECT business_id, date + INTERVAL 60 SECOND AS time, text FROM dated
    WHERE event_type = 'purchase'""",
)


@query("l6_maps_reviews", MAPS_REVIEWS_RESULT)
def maps_reviews(t):
    return plans.build_maps_reviews({"reviews": inputs.maps_reviews(t)})["reviews"]


@query("l6_maps_replies", REPLIES_RESULT)
def maps_replies(t):
    return plans.build_maps_reviews({"reviews": inputs.maps_reviews(t)})["resp_reviews"]


YELP_REVIEWS_RESULT = with_ctes(
    *KEPT_YELP,
    inputs.YELP_REVIEWS_SQL,
    body="""SELECT business_id, user_id, date, stars, useful, funny, cool, text, platform
    FROM yelp_reviews WHERE year(date) BETWEEN 2010 AND 2021
      AND business_id IN (SELECT business_id FROM kept)""",
)


@query("l7_yelp_reviews", YELP_REVIEWS_RESULT)
def yelp_reviews(t):
    tables = {**_yelp(t), "reviews": inputs.yelp_reviews(t)}
    return plans.build_yelp_reviews(tables, order_by=["source_seq"], scope="global")["reviews"]


@query("l8_yelp_tips", inputs.TIPS_RESULT)
def yelp_tips(t):
    return plans.build_yelp_tips({"tips": inputs.yelp_tips(t)})["tips_yelp"]


@query("l9_yelp_users", inputs.USERS_RESULT)
def yelp_users(t):
    users = {"users": inputs.yelp_users(t)}
    return plans.build_yelp_users(users, order_by=["source_seq"], scope="global")["users_yelp"]


@query("l10_homicides", inputs.HOMICIDES_RESULT)
def homicides(t):
    return plans.build_homicides({"homicides": inputs.homicides(t)})["hechos_homicidios"]


@query(
    "l11_new_maps_reviews",
    with_ctes(
        inputs.MAPS_REVIEWS_SQL,
        body="""SELECT business_id, user_id, date, stars, useful, funny, cool, text, platform
    FROM dated WHERE event_type IN ('click', 'view', 'signup')""",
    ),
)
def new_maps_reviews(t):
    """The target holds the errors as they are and the purchases with another text."""
    reviews = inputs.maps_reviews(t)
    loaded = plans.build_maps_reviews({"reviews": reviews})["reviews"]
    target = loaded.filter(F.col("stars").isin(8)).withColumn("text", F.lit("old"))
    errors = t.events.filter("event_type = 'error'").select(
        F.concat(F.lit("1000000000000"), F.lpad(F.col("event_id").cast("string"), 8, "0")).alias(
            "user_id"
        )
    )
    target = target.unionByName(loaded.join(errors, "user_id", "left_semi"))
    return plans.build_maps_new_reviews({"reviews": reviews, "target": target}, prune=True)[
        "reviews"
    ]


@query("l11_incremental_loads", MAPS_REVIEWS_RESULT)
def incremental_loads(t):
    """Three runs of the incremental load: a first part, everything, and everything again."""
    path = scratch_path(t.spark, "l11")
    reviews = inputs.maps_reviews(t)
    for run, batch in enumerate([reviews.filter("rating <= 5"), reviews, reviews]):
        target = sinks.read_loads(t.spark, path, S.REVIEWS)
        tables = {"reviews": batch, "target": target}
        new = plans.build_maps_new_reviews(tables)["reviews"]
        sinks.load_once(new, path, S.REVIEWS, f"run-{run}")
    return sinks.read_loads(t.spark, path, S.REVIEWS)


@query(
    "l12_locations",
    with_ctes(
        inputs.POINTS_SQL,
        inputs.GAZETTEER_SQL,
        inputs.nearest_sql(40),
        body="""SELECT business_id, latitude, longitude, ciudad, estado
    FROM points LEFT JOIN nearest USING (business_id)""",
    ),
)
def locations(t):
    """All pages of the businesses, written one by one and read together."""
    path = scratch_path(t.spark, "l12")
    sides = {"business": inputs.points(t), "gazetteer": inputs.gazetteer(t)}
    half = -(-sides["business"].count() // 2)
    for run, tables in enumerate(plans.location_pages(sides, half, max_km=40)):
        sinks.write_csv(tables["business"], path, run_id=str(run))
    schema = S.table(business_id=S.STR, latitude=S.DBL, longitude=S.DBL, ciudad=S.STR, estado=S.STR)
    return sources.read_many(
        t.spark, path, "csv", schema, glob="*.csv", with_file=False, header="true"
    )


@query(
    "l12_location_page",
    """SELECT c_custkey FROM customer ORDER BY c_acctbal, c_custkey LIMIT 100 OFFSET 20""",
)
def location_page(t):
    customers = t.customer.select("c_custkey", "c_acctbal")
    return row_range(customers, ["c_acctbal", "c_custkey"], 20, 120).select("c_custkey")


@query(
    "l13_state_dimension",
    with_ctes(inputs.STATES_SQL, body="SELECT nombre_largo, nombre_corto, codigos FROM states"),
)
def state_dimension(t):
    path = scratch_path(t.spark, "l13")
    tables = plans.build_state_dimension({"states": inputs.states(t)})
    sinks.write_all(tables, lambda name, df: sinks.save(df, f"{path}/{name}"))
    return sources.read_parquet(t.spark, f"{path}/estados_usa2")
