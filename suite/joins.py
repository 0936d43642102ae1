"""Joins, set operations and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from placemill.operators import (
    attach_place,
    attach_state,
    dedupe_first,
    only_new,
    parse_address,
    restrict_to,
)
from suite import inputs
from suite.inputs import with_ctes
from suite.registry import query


def _coded_business(t):
    return inputs.yelp_business(t).withColumn("state", F.btrim("state", F.lit(" \t")))


@query(
    "j1_attach_state",
    with_ctes(
        inputs.STATES_SQL,
        inputs.YELP_SQL,
        body="""SELECT source_seq, trim(nombre_largo) AS estado
    FROM yelp JOIN states ON code = nombre_corto""",
    ),
)
def state_names(t):
    named = attach_state(_coded_business(t).dropna(subset=["state"]), inputs.states(t), "state")
    return named.dropna(subset=["estado"]).select("source_seq", "estado")


@query(
    "j1b_attach_state_left",
    with_ctes(
        inputs.STATES_SQL,
        inputs.YELP_SQL,
        body="""SELECT source_seq, code AS state, trim(nombre_largo) AS estado
    FROM yelp LEFT JOIN (SELECT * FROM states WHERE nombre_corto < 'NZ') ON code = nombre_corto""",
    ),
)
def state_names_left(t):
    some = inputs.states(t).filter(F.col("nombre_corto") < "NZ")
    return attach_state(_coded_business(t), some, "state").select("source_seq", "state", "estado")


@query(
    "j2_restrict_to",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def restricted(t):
    chosen = t.customer.filter("c_mktsegment = 'BUILDING'")
    keys = chosen.select(F.col("c_custkey").alias("o_custkey"))
    return restrict_to(t.orders.select("o_orderkey", "o_custkey"), keys, "o_custkey")


@query(
    "j3_count_and_name",
    """SELECT p_partkey AS game_id, p_name AS game_name, count(*) AS size
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
def count_and_name(t):
    counts = t.lineitem.groupBy(F.col("l_partkey").alias("game_id")).agg(
        F.count("*").alias("size")
    )
    games = t.part.select(F.col("p_partkey").alias("game_id"), F.col("p_name").alias("game_name"))
    return counts.join(games, "game_id").select("game_id", "game_name", "size")


@query(
    "j3b_filtered_games_reviews",
    with_ctes(
        inputs.GAME_REVIEWS_SQL,
        body="""SELECT game_id, sentiment AS sentiment_analysis, r.year
    FROM game_reviews r JOIN part ON game_id = p_partkey WHERE p_size + 1990 = 2001""",
    ),
)
def filtered_games_reviews(t):
    games = dedupe_first(inputs.games(t), ["game_id"], ["release_year"], scope="global")
    released = games.filter(F.col("release_year") == 2001).select("game_id")
    # Ids are unique after deduplication, so the join only restricts.
    rows = restrict_to(inputs.game_reviews(t), released, "game_id")
    return rows.select("game_id", "sentiment_analysis", "year")


SHIPPED = """batch AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate,
      l_returnflag AS text FROM lineitem),
    target AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, 'old' AS text
      FROM lineitem WHERE l_linestatus = 'F')"""
ONLY_NEW_SQL = with_ctes(
    SHIPPED,
    body="""SELECT * FROM batch b WHERE NOT EXISTS (
      SELECT 1 FROM target t WHERE t.l_orderkey = b.l_orderkey
        AND t.l_linenumber = b.l_linenumber AND t.l_partkey = b.l_partkey
        AND t.l_quantity = b.l_quantity AND t.l_shipdate = b.l_shipdate)""",
)


def _shipped(t):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"]
    batch = t.lineitem.select(*columns, F.col("l_returnflag").alias("text"))
    target = t.lineitem.filter("l_linestatus = 'F'").select(*columns, F.lit("old").alias("text"))
    return batch, target, [*columns, "text"]


@query("j4_only_new", ONLY_NEW_SQL)
def new_rows(t):
    batch, target, columns = _shipped(t)
    return only_new(batch, target).select(*columns)


@query("u2_difference", ONLY_NEW_SQL)
def difference(t):
    """The same difference with the target scan limited to the batch's dates."""
    batch, target, columns = _shipped(t)
    return only_new(batch, target, prune_on="l_shipdate").select(*columns)


@query(
    "j5_dictionary_lookup",
    with_ctes(
        inputs.STATES_SQL,
        body=f"""SELECT c_custkey, coalesce(trim(nombre_largo), 'SIN DATO') AS state
    FROM customer LEFT JOIN states ON CASE WHEN c_mktsegment = 'BUILDING' THEN 'ZZ'
      ELSE {inputs.sql_code("c_nationkey")} END = nombre_corto""",
    ),
)
def dictionary_lookup(t):
    code = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("ZZ")).otherwise(
        inputs.code_of("c_nationkey")
    )
    coded = t.customer.select("c_custkey", code.alias("code"))
    named = attach_state(coded, inputs.states(t), "code", out="state").fillna({"state": "SIN DATO"})
    return named.select("c_custkey", "state")


@query(
    "j6_containment_lookup",
    with_ctes(
        inputs.STATES_SQL,
        """coded AS (SELECT doc_id, substr(upper(lang), 1, length(source) - 3) AS frag
      FROM documents)""",
        body="""SELECT doc_id, coalesce(trim((
        SELECT arg_min(nombre_largo, pos) FROM states WHERE contains(nombre_corto, frag))),
      'SIN DATO') AS state FROM coded""",
    ),
)
def containment_lookup(t):
    """One- and two-letter fragments cut from the language of a document."""
    frag = F.substring(F.upper("lang"), F.lit(1), F.length("source") - 3)
    address = F.concat(F.lit("12 Long Road, Somewhere, "), frag)
    coded = t.documents.select("doc_id", address.alias("address"))
    parsed = parse_address(coded, inputs.states(t), mode="contains", order_by="pos")
    return parsed.select("doc_id", "state")


@query(
    "j7_nearest_place",
    with_ctes(
        inputs.POINTS_SQL,
        inputs.GAZETTEER_SQL,
        inputs.nearest_sql(30),
        body="""SELECT p.business_id, ciudad, estado
    FROM points p LEFT JOIN nearest USING (business_id)""",
    ),
)
def nearest_place(t):
    placed = attach_place(inputs.points(t), inputs.gazetteer(t), max_km=30, cell_deg=0.5)
    return placed.select("business_id", "ciudad", "estado")


@query(
    "u1_append_frames",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def append_frames(t):
    customers = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("u3_distinct_strings", "SELECT DISTINCT source FROM documents")
def distinct_strings(t):
    return t.documents.select("source").distinct()


FIRST_EVENT = """SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY {} ORDER BY ts, event_id) = 1"""


@query("d1_first_per_key", FIRST_EVENT.format("user_id"))
def first_per_key(t):
    first = dedupe_first(t.events, ["user_id"], ["ts", "event_id"], scope="global")
    return first.select("user_id", "event_id", "event_type", "value")


@query("d1b_any_per_key", "SELECT DISTINCT user_id, event_type FROM events")
def any_per_key(t):
    return t.events.dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")


@query("d2_first_per_file_and_key", FIRST_EVENT.format("event_type, user_id"))
def first_per_file_and_key(t):
    """The event type stands for the input file."""
    placed = t.events.withColumn("source_file", F.col("event_type"))
    first = dedupe_first(placed, ["user_id"], ["ts", "event_id"], scope="file")
    return first.select("user_id", "event_id", "event_type", "value")
