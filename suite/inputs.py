"""Domain inputs derived from the test tables, in Spark and as SQL.

Every function gives one input of the library from whole test tables; the
constant next to it is the same table as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.registry import Tables

# One US state per nation key.
CODES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN NY OH OK OR PA RI TN TX UT VA WA"
).split()
NAMES = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut",
    "Delaware", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "New York",
    "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "Tennessee", "Texas", "Utah",
    "Virginia", "Washington",
]
KEPT = "('Florida', 'Pennsylvania', 'Tennessee', 'California', 'Texas', 'New York')"


def sql_list(items) -> str:
    return "[" + ", ".join(f"'{item}'" for item in items) + "]"


def _nth(items, key: str):
    return F.get(F.array(*[F.lit(item) for item in items]), F.col(key))


def code_of(key: str):
    """The state code of a nation key."""
    return _nth(CODES, key)


def sql_code(key: str) -> str:
    return f"{sql_list(CODES)}[{key} + 1]"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# ---- state dimension ----------------------------------------------------------


def states(t: Tables) -> DataFrame:
    """Nations renamed to states; long names end in a blank."""
    return t.nation.select(
        F.concat(_nth(NAMES, "n_nationkey"), F.lit(" ")).alias("nombre_largo"),
        code_of("n_nationkey").alias("nombre_corto"),
        F.concat(F.lit(" "), F.col("n_name")).alias("codigos"),
        F.col("n_nationkey").alias("pos"),
    )


STATES_SQL = f"""states AS (
  SELECT {sql_list(NAMES)}[n_nationkey + 1] || ' ' AS nombre_largo,
         {sql_code("n_nationkey")} AS nombre_corto, ' ' || n_name AS codigos,
         n_nationkey AS pos
  FROM nation)"""

# ---- Maps places: one per order, several per customer -------------------------


def sites(t: Tables) -> DataFrame:
    code = code_of("c_nationkey")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    address = (
        F.when(priority == "5-LOW", F.lit(None))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lit("1 Main St, Tampa,"), code, F.lit(" 3")))
        .when(priority == "3-MEDIUM", F.concat(F.lit("Tampa, "), code))
        .otherwise(
            F.concat(F.lit("1 Main St, "), "c_name", F.lit(" "), status, F.lit(" , "), code, F.lit(" 33601"))
        )
    )
    category = F.when(
        F.col("c_mktsegment") == "BUILDING", F.array(F.lit("Thai Restaurant"))
    ).when(F.col("c_mktsegment") != "MACHINERY", F.array(F.lit("Restaurant"), "c_mktsegment"))
    service = F.when(status == "F", F.array().cast("array<string>")).otherwise(
        F.array(priority, status)
    )
    misc = F.when(
        status == "P",
        F.create_map(
            F.lit("Service options"), service, F.lit("Planning"), F.array("c_mktsegment")
        ),
    ).when(status == "F", F.create_map(F.lit("Service options"), service))
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("g"), F.col("o_custkey").cast("string")).alias("gmap_id"),
        F.concat("c_name", F.lit("/"), priority).alias("name"),
        address.alias("address"),
        category.alias("category"),
        (F.col("c_acctbal") / 1000 + 25).alias("latitude"),
        (F.lit(-80.0) - F.col("c_nationkey")).alias("longitude"),
        (F.col("c_acctbal") / 2000).alias("avg_rating"),
        F.when(status != "F", F.concat(F.lit("$"), status)).alias("price"),
        F.col("c_mktsegment").alias("state"),
        misc.alias("MISC"),
        F.date_format("o_orderdate", "yyyy").alias("source_file"),
        F.lit(0).cast("long").alias("source_block"),
        F.col("o_orderkey").alias("source_seq"),
    )


SITES_SQL = f"""sites AS (
  SELECT 'g' || o_custkey AS gmap_id, c_name || '/' || o_orderpriority AS name,
    CASE o_orderpriority
      WHEN '5-LOW' THEN NULL
      WHEN '4-NOT SPECIFIED' THEN '1 Main St, Tampa,' || {sql_code("c_nationkey")} || ' 3'
      WHEN '3-MEDIUM' THEN 'Tampa, ' || {sql_code("c_nationkey")}
      ELSE '1 Main St, ' || c_name || ' ' || o_orderstatus || ' , '
           || {sql_code("c_nationkey")} || ' 33601' END AS address,
    CASE WHEN c_mktsegment = 'BUILDING' THEN ['Thai Restaurant']
         WHEN c_mktsegment <> 'MACHINERY' THEN ['Restaurant', c_mktsegment] END AS category,
    c_acctbal / 1000 + 25 AS latitude, -80.0::DOUBLE - c_nationkey AS longitude,
    c_acctbal / 2000 AS avg_rating,
    CASE WHEN o_orderstatus <> 'F' THEN '$' || o_orderstatus END AS price,
    c_mktsegment AS raw_state,
    CASE o_orderstatus WHEN 'P' THEN [o_orderpriority, o_orderstatus]
         WHEN 'F' THEN []::VARCHAR[] END AS service,
    CASE WHEN o_orderstatus = 'P' THEN [c_mktsegment] END AS planning,
    strftime(o_orderdate, '%Y') AS source_file, o_orderkey AS source_seq
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def kept_sites_sql(partition: str = "source_file, gmap_id") -> str:
    """The places that survive deduplication, filters and address parsing."""
    return f"""first_sites AS (
  SELECT * FROM sites
  QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY source_file, source_seq) = 1),
kept AS (
  SELECT s.*, trim(string_split(address, ',')[-2]) AS city, trim(d.nombre_largo) AS state
  FROM first_sites s JOIN states d
    ON length(address) > 10 AND len(string_split(address, ',')) > 2
   AND substr(string_split(address, ',')[-1], 2, 2) = d.nombre_corto
  WHERE list_contains(category, 'Restaurant') AND trim(d.nombre_largo) IN {KEPT})"""


BUSINESS_FROM_KEPT = """SELECT gmap_id AS business_id, name, city, state, latitude, longitude,
  avg_rating AS stars, coalesce(price, 'SIN DATO') AS price, 1::BIGINT AS platform FROM kept"""

# ---- Maps reviews: one per event ------------------------------------------------


def millis(col):
    """Epoch milliseconds of a zone-less timestamp."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col)


def maps_reviews(t: Tables) -> DataFrame:
    """Event times are moved back by up to 49 years, so that years fall out."""
    moved = F.round(F.col("value") * 100).cast("long") * 31_000_000
    time = millis(F.col("ts")) - moved
    reply = F.when(
        F.col("event_type") == "purchase",
        F.struct((time + 60_000).alias("time"), F.col("props").alias("text")),
    )
    return t.events.select(
        F.concat(F.lit("g"), F.col("user_id").cast("string")).alias("gmap_id"),
        F.concat(F.lit("1000000000000"), F.lpad(F.col("event_id").cast("string"), 8, "0")).alias(
            "user_id"
        ),
        time.alias("time"),
        F.length("event_type").cast("long").alias("rating"),
        F.col("props").alias("text"),
        reply.alias("resp"),
    )


MAPS_REVIEWS_SQL = """maps_reviews AS (
  SELECT 'g' || user_id AS business_id,
    '1000000000000' || lpad(event_id::VARCHAR, 8, '0') AS user_id,
    make_timestamp((epoch_us(ts) // 1000 - round(value * 100)::BIGINT * 31000000) * 1000) AS date,
    length(event_type)::BIGINT AS stars, 0::BIGINT AS useful, 0::BIGINT AS funny,
    0::BIGINT AS cool, props AS text, 1::BIGINT AS platform, event_type
  FROM events),
dated AS (SELECT * FROM maps_reviews WHERE year(date) BETWEEN 2010 AND 2021)"""

# ---- Yelp businesses: one per order, several per customer -----------------------


def yelp_business(t: Tables) -> DataFrame:
    segment, status = F.col("c_mktsegment"), F.col("o_orderstatus")
    categories = (
        F.when(segment == "BUILDING", F.lit(None))
        .when(segment == "FURNITURE", F.lit("Burgers, Restaurants"))
        .when(segment == "MACHINERY", F.lit("Burgers,Restaurants"))
        .otherwise(F.concat(F.lit("Restaurants, "), segment, F.lit(" ,"), status))
    )
    code = F.when(status == "F", F.lit(None)).otherwise(
        F.concat(F.lit(" "), code_of("c_nationkey"), F.lit("\t"))
    )
    attributes = F.when(
        status != "F",
        F.create_map(
            F.lit("HasTV"), F.col("o_orderpriority"), F.lit("RestaurantsTakeOut"), status
        ),
    )
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("b"), F.col("o_custkey").cast("string")).alias("business_id"),
        F.concat("c_name", F.lit("/"), F.col("o_orderkey").cast("string")).alias("name"),
        F.concat(F.lit("City "), segment).alias("city"),
        code.alias("state"),
        (F.col("c_acctbal") / 1000 + 25).alias("latitude"),
        (F.lit(-80.0) - F.col("c_nationkey")).alias("longitude"),
        (F.col("c_acctbal") / 2000).alias("stars"),
        categories.alias("categories"),
        attributes.alias("attributes"),
        F.col("o_orderkey").alias("source_seq"),
        F.concat(segment, F.lit("ville")).alias("ciudad"),
        F.concat(_nth(NAMES, "c_nationkey"), F.lit("\t ")).alias("estado"),
    )


YELP_SQL = f"""yelp AS (
  SELECT 'b' || o_custkey AS business_id, c_name || '/' || o_orderkey AS name,
    'City ' || c_mktsegment AS city,
    CASE WHEN o_orderstatus <> 'F' THEN {sql_code("c_nationkey")} END AS code,
    c_acctbal / 1000 + 25 AS latitude, -80.0::DOUBLE - c_nationkey AS longitude,
    c_acctbal / 2000 AS stars,
    CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'FURNITURE' THEN 'Burgers, Restaurants'
      WHEN 'MACHINERY' THEN 'Burgers,Restaurants'
      ELSE 'Restaurants, ' || c_mktsegment || ' ,' || o_orderstatus END AS categories,
    CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS has_tv,
    CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS take_out,
    o_orderkey AS source_seq, c_mktsegment || 'ville' AS ciudad,
    {sql_list(NAMES)}[c_nationkey + 1] AS estado
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

KEPT_YELP_SQL = f"""first_yelp AS (
  SELECT * FROM yelp
  QUALIFY row_number() OVER (PARTITION BY business_id ORDER BY source_seq) = 1),
kept AS (
  SELECT y.* EXCLUDE (estado), trim(d.nombre_largo) AS state
  FROM first_yelp y JOIN states d ON y.code = d.nombre_corto
  WHERE list_contains(string_split(categories, ','), 'Restaurants')
    AND trim(d.nombre_largo) IN {KEPT})"""

# ---- Yelp reviews, tips and users -------------------------------------------------


def _later(col: str, days: int):
    return F.timestamp_add("DAY", F.lit(days), F.col(col))


def yelp_reviews(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), "l_linenumber").alias("review_id"),
        F.concat(F.lit("b"), F.col("l_partkey").cast("string")).alias("business_id"),
        F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("user_id"),
        _later("l_shipdate", 8000).alias("date"),
        F.col("l_linenumber").cast("long").alias("stars"),
        F.col("l_quantity").cast("long").alias("useful"),
        F.lit(0).cast("long").alias("funny"),
        F.lit(1).cast("long").alias("cool"),
        F.concat("l_returnflag", "l_linestatus").alias("text"),
    )


YELP_REVIEWS_SQL = """yelp_reviews AS (
  SELECT 'b' || l_partkey AS business_id, 'u' || l_suppkey AS user_id,
    l_shipdate + INTERVAL 8000 DAY AS date, l_linenumber::BIGINT AS stars,
    l_quantity::BIGINT AS useful, 0::BIGINT AS funny, 1::BIGINT AS cool,
    l_returnflag || l_linestatus AS text, 2::BIGINT AS platform
  FROM lineitem)"""


def yelp_tips(t: Tables) -> DataFrame:
    return t.orders.select(
        F.concat(F.lit("b"), F.col("o_custkey").cast("string")).alias("business_id"),
        F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("user_id"),
        _later("o_orderdate", 5000).alias("date"),
        F.col("o_orderpriority").alias("text"),
        F.lit(0).cast("long").alias("compliment_count"),
    )


TIPS_RESULT = """SELECT 'b' || o_custkey AS business_id, 'u' || o_orderkey AS user_id,
  o_orderdate + INTERVAL 5000 DAY AS date, o_orderpriority AS text FROM orders
  WHERE year(o_orderdate + INTERVAL 5000 DAY) BETWEEN 2010 AND 2021"""


def yelp_users(t: Tables) -> DataFrame:
    zero = F.lit(0).cast("long")
    return t.orders.select(
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").alias("review_count"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("yelping_since"),
        zero.alias("useful"),
        zero.alias("funny"),
        zero.alias("cool"),
        zero.alias("fans"),
        F.col("o_totalprice").alias("average_stars"),
        F.col("o_orderstatus").alias("elite"),
        F.col("o_orderkey").alias("source_seq"),
    )


USERS_RESULT = """SELECT 'u' || o_custkey AS user_id, o_orderpriority AS name,
  o_orderkey AS review_count, o_orderdate AS yelping_since, 0::BIGINT AS useful,
  0::BIGINT AS funny, 0::BIGINT AS cool, 0::BIGINT AS fans, o_totalprice AS average_stars
  FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1"""

# ---- homicide facts ----------------------------------------------------------------


def homicides(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    longitude = F.when(priority == "5-LOW", F.lit("SIN DATO")).when(
        priority != "1-URGENT", F.concat(F.lit("-58."), F.col("o_custkey").cast("string"))
    )
    return t.orders.select(
        F.concat(F.lit("h"), F.col("o_orderkey").cast("string")).alias("Id_hecho"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("FECHA"),
        F.col("o_custkey").alias("COMUNA"),
        longitude.alias("LONGITUD"),
        F.col("o_orderstatus").alias("LATITUD"),
        *[
            F.lit("x").alias(name)
            for name in (
                "N_VICTIMAS", "HORA", "TIPO_DE_CALLE", "VICTIMA", "ACUSADO", "PARTICIPANTES",
            )
        ],
    )


HOMICIDES_RESULT = """SELECT 'h' || o_orderkey AS Id_hecho, o_orderdate::DATE AS FECHA,
  o_custkey AS COMUNA,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN '-58.' || o_custkey END AS LONGITUD,
  o_orderstatus AS LATITUD FROM orders WHERE o_orderpriority <> '5-LOW'"""

# ---- game catalogue -------------------------------------------------------------------


def games(t: Tables) -> DataFrame:
    """Two genres per part."""
    return t.part.select(
        F.col("p_partkey").alias("game_id"),
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("game_name"),
        F.explode(F.array("p_brand", "p_type")).alias("genres"),
        (F.col("p_size") + 1990).alias("release_year"),
    )


GAMES_SQL = """games AS (
  SELECT p_partkey AS game_id, p_name || ' ' || p_partkey AS game_name,
    unnest([p_brand, p_type]) AS genres, p_size + 1990 AS release_year FROM part)"""


def game_reviews(t: Tables) -> DataFrame:
    """A tenth of the reviewed items are not in the catalogue."""
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    item = F.when(F.col("l_linenumber") == 7, -F.col("l_suppkey") - 1).otherwise(F.col("l_partkey"))
    return t.lineitem.select(
        item.alias("game_id"),
        (flag != "R").alias("recommend"),
        F.when(status == "F", 0).when(flag == "A", 1).otherwise(2).alias("sentiment_analysis"),
        F.year("l_shipdate").alias("year"),
    )


GAME_REVIEWS_SQL = """game_reviews AS (
  SELECT CASE WHEN l_linenumber = 7 THEN -l_suppkey - 1 ELSE l_partkey END AS game_id,
    l_returnflag <> 'R' AS recommend,
    CASE WHEN l_linestatus = 'F' THEN 0 WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS sentiment,
    year(l_shipdate)::INTEGER AS year FROM lineitem)"""


def user_genre(t: Tables) -> DataFrame:
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("user_id"),
            F.lower("p_brand").alias("genres"),
            F.year("o_orderdate").alias("release_year"),
            F.col("l_quantity").cast("long").alias("playtime_forever"),
        )
    )


USER_GENRE_SQL = """user_genre AS (
  SELECT lpad(o_custkey::VARCHAR, 12, '0') AS user_id, lower(p_brand) AS genres,
    year(o_orderdate)::INTEGER AS release_year, l_quantity::BIGINT AS playtime
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def game_model(t: Tables) -> DataFrame:
    return t.embeddings.select(
        (F.col("vec_id") + 1000).alias("game_id"),
        F.concat(F.lit("item "), F.col("vec_id").cast("string")).alias("game_name"),
        F.col("vec_id").alias("idx"),
    )


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("idx"), "embedding")


def similarity(t: Tables) -> DataFrame:
    """Items and suppliers, as similar as the quantity sold of the pair."""
    return t.lineitem.groupBy(F.col("l_partkey").alias("i"), F.col("l_suppkey").alias("j")).agg(
        F.sum("l_quantity").alias("sim")
    )


SIMILARITY_SQL = """sims AS (
  SELECT l_partkey AS i, l_suppkey AS j, sum(l_quantity) AS sim FROM lineitem GROUP BY ALL)"""

# ---- recommender features and coordinates ----------------------------------------------


def location_features(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        _nth(NAMES, "c_nationkey").alias("state"),
        F.col("c_mktsegment").alias("category_name"),
        (F.col("c_acctbal") / 1000 + 25).alias("latitude"),
        (F.lit(-80.0) - F.col("o_totalprice") / 100_000).alias("longitude"),
        (F.col("c_acctbal") / 2000).alias("business_stars"),
        F.lit(1.0).alias("business_platform"),
        (F.col("o_totalprice") / 100_000).alias("review_stars"),
        F.lit(2.0).alias("review_platform"),
        F.length("o_orderpriority").cast("double").alias("sentimiento"),
        F.col("o_custkey").cast("double").alias("densidad_restaurantes"),
        F.dayofyear("o_orderdate").cast("double").alias("distancia_restaurantes_populares"),
    )


FEATURES_SQL = f"""features AS (
  SELECT {sql_list(NAMES)}[c_nationkey + 1] AS state, c_mktsegment AS category_name,
    c_acctbal / 1000 + 25 AS latitude, -80.0::DOUBLE - o_totalprice / 100000 AS longitude,
    c_acctbal / 2000 AS business_stars, 1.0::DOUBLE AS business_platform,
    o_totalprice / 100000 AS review_stars, 2.0::DOUBLE AS review_platform,
    length(o_orderpriority)::DOUBLE AS sentimiento,
    o_custkey::DOUBLE AS densidad_restaurantes,
    dayofyear(o_orderdate)::DOUBLE AS distancia_restaurantes_populares
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def points(t: Tables) -> DataFrame:
    """Customers spread over about 11 by 5 degrees."""
    return t.customer.select(
        F.concat(F.lit("b"), F.col("c_custkey").cast("string")).alias("business_id"),
        (F.col("c_acctbal") / 1000 + 25).alias("latitude"),
        (F.lit(-80.0) - F.col("c_nationkey") / 5).alias("longitude"),
    )


POINTS_SQL = """points AS (
  SELECT 'b' || c_custkey AS business_id, c_acctbal / 1000 + 25 AS latitude,
    -80.0::DOUBLE - c_nationkey / 5 AS longitude FROM customer)"""


def gazetteer(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_name").alias("city"),
        _nth(NAMES, "s_nationkey").alias("state"),
        (F.col("s_acctbal") / 1000 + 25).alias("latitude"),
        (F.lit(-80.0) - F.col("s_nationkey") / 5).alias("longitude"),
    )


GAZETTEER_SQL = f"""gazetteer AS (
  SELECT s_name AS city, {sql_list(NAMES)}[s_nationkey + 1] AS state,
    s_acctbal / 1000 + 25 AS latitude, -80.0::DOUBLE - s_nationkey / 5 AS longitude
  FROM supplier)"""


def nearest_sql(max_km: float) -> str:
    """Nearest place within ``max_km`` by comparing every pair."""
    return f"""paired AS (
  SELECT p.business_id, g.city, g.state, 2 * 6371.0088 * asin(sqrt(least(1.0,
      pow(sin(radians(g.latitude - p.latitude) / 2), 2)
      + cos(radians(p.latitude)) * cos(radians(g.latitude))
        * pow(sin(radians(g.longitude - p.longitude) / 2), 2)))) AS km
  FROM points p CROSS JOIN gazetteer g),
nearest AS (
  SELECT business_id, arg_min(city, (km, city, state)) AS ciudad,
    arg_min(state, (km, city, state)) AS estado
  FROM paired WHERE km <= {max_km} GROUP BY business_id)"""
