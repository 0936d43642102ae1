"""Sources and sinks: whole tables written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from placemill import schemas as S
from placemill import sinks, sources
from placemill.operators import map_columns, split_contiguous, with_row_index
from placemill.plans import build_maps_sites
from placemill.runtime import scratch_path
from suite import inputs
from suite.inputs import with_ctes
from suite.registry import query

TURNS = S.table(conv_id=S.LONG, turn=S.LONG, role=S.STR, text=S.STR)
TURNS_SQL = "SELECT conv_id, turn, role, text FROM conversations"
ORDER_LINES = S.table(o_orderkey=S.LONG, o_custkey=S.LONG, o_orderpriority=S.STR)


@query("s1_json_lines", TURNS_SQL)
def json_lines(t):
    path = scratch_path(t.spark, "s1")
    t.conversations.write.json(path)
    return sources.read_json(t.spark, path, TURNS)


@query("s2_json_array", TURNS_SQL)
def json_array(t):
    path = scratch_path(t.spark, "s2")
    sinks.write_json_arrays(t.conversations, path)
    return sources.read_json(t.spark, path, TURNS, array=True)


@query("s2_split_array", TURNS_SQL)
def split_array(t):
    """The same array files, cut into objects by any number of tasks."""
    path = scratch_path(t.spark, "s2s")
    sinks.write_json_arrays(t.conversations, path)
    return sources.read_json_objects(t.spark, path, TURNS)


@query(
    "s3_semicolon_csv",
    with_ctes(inputs.STATES_SQL, body="SELECT nombre_largo, nombre_corto, codigos FROM states"),
)
def semicolon_csv(t):
    path = scratch_path(t.spark, "s3")
    states = inputs.states(t).select(*S.STATE_DIM.names)
    # Blanks around values are data here.
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    states.write.options(header=True, sep=";", **keep).csv(path)
    return sources.read_delimited(t.spark, path, S.STATE_DIM, sep=";")


@query("s4_comma_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def comma_csv(t):
    path = sinks.write_csv(t.documents, scratch_path(t.spark, "s4"))
    return sources.read_delimited(t.spark, path, t.documents.schema, multiline=True)


@query("s5_parquet", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def parquet(t):
    wanted = S.table(c_custkey=S.LONG, c_name=S.STR, c_mktsegment=S.STR)
    return sources.read_parquet(t.spark, f"{t.folder}/customer.parquet", schema=wanted)


@query(
    "s6_business_table",
    with_ctes(
        inputs.YELP_SQL,
        body="SELECT business_id, source_seq, code, categories, has_tv, take_out FROM yelp",
    ),
)
def business_table(t):
    path = scratch_path(t.spark, "s6")
    inputs.yelp_business(t).write.parquet(path)
    read = sources.read_parquet(t.spark, path)
    return map_columns(read, "attributes", ["HasTV", "RestaurantsTakeOut"]).select(
        "business_id",
        "source_seq",
        F.btrim("state", F.lit(" \t")).alias("code"),
        "categories",
        F.col("HasTV").alias("has_tv"),
        F.col("RestaurantsTakeOut").alias("take_out"),
    )


@query("s7_similarity_table", with_ctes(inputs.SIMILARITY_SQL, body="SELECT i, j, sim FROM sims"))
def similarity_table(t):
    path = scratch_path(t.spark, "s7")
    inputs.similarity(t).write.parquet(path)
    return sources.read_parquet(t.spark, path, schema=S.SIMILARITY)


@query(
    "s8_many_files",
    """SELECT o_orderkey, o_custkey, o_orderpriority,
      'status=' || o_orderstatus AS folder FROM orders""",
)
def many_files(t):
    path = scratch_path(t.spark, "s8")
    t.orders.select(*ORDER_LINES.names, F.col("o_orderstatus").alias("status")).write.partitionBy(
        "status"
    ).json(path)
    t.nation.write.mode("append").csv(f"{path}/other")
    read = sources.read_many(t.spark, path, "json", ORDER_LINES, glob="*.json")
    folder = F.element_at(F.split("source_file", "/"), -2)
    return read.select(*ORDER_LINES.names, folder.alias("folder"))


def _by_status(t, name: str) -> str:
    """Orders as CSV in one folder per status."""
    path = scratch_path(t.spark, name)
    t.orders.withColumn("status", F.col("o_orderstatus")).write.partitionBy("status").csv(path)
    return path


@query(
    "s9_file_listing",
    "SELECT DISTINCT 'status=' || o_orderstatus AS folder, 0::BIGINT AS empty_files FROM orders",
)
def file_listing(t):
    files = sources.list_files(t.spark, _by_status(t, "s9"), ".csv")
    folder = F.element_at(F.split("path", "/"), -2).alias("folder")
    return files.groupBy(folder).agg(F.count_if(F.col("length") <= 0).alias("empty_files"))


@query(
    "s10_parent_globs",
    "SELECT DISTINCT 'status=' || o_orderstatus || '/*.csv' AS glob FROM orders",
)
def parent_globs(t):
    path = _by_status(t, "s10")
    globs = sources.parent_globs(sources.list_files(t.spark, path))
    return globs.select(F.substring_index("glob", "/", -2).alias("glob"))


BUSINESS_SQL = with_ctes(
    inputs.STATES_SQL, inputs.SITES_SQL, inputs.kept_sites_sql(), body=inputs.BUSINESS_FROM_KEPT
)


def _business(t):
    return build_maps_sites({"sites": inputs.sites(t), "states": inputs.states(t)})


@query("k1_append_table", f"{BUSINESS_SQL} UNION ALL {inputs.BUSINESS_FROM_KEPT}")
def append_table(t):
    """The first load creates the table, the second appends."""
    table, path = f"business_{uuid.uuid4().hex}", scratch_path(t.spark, "k1")
    business = _business(t)["business"]
    sinks.append_table(business, table, S.BUSINESS, path=path)
    sinks.append_table(business, table, S.BUSINESS, path=path)
    return t.spark.table(table)


@query("k1_load_once", f"{BUSINESS_SQL} UNION ALL {inputs.BUSINESS_FROM_KEPT}")
def load_once(t):
    """Two loads, each run twice: the reruns add nothing."""
    path = scratch_path(t.spark, "k1o")
    business = _business(t)["business"]
    for load_id in ("monday", "tuesday", "monday", "tuesday"):
        sinks.load_once(business, path, S.BUSINESS, load_id)
    return sinks.read_loads(t.spark, path, S.BUSINESS)


@query("k2_connector_append", f"{BUSINESS_SQL} UNION ALL {inputs.BUSINESS_FROM_KEPT}")
def connector_append(t):
    path = scratch_path(t.spark, "k2")
    business = _business(t)["business"]
    for _ in range(2):
        sinks.save(business, path, fmt="json", options={"ignoreNullFields": "false"})
    return sources.read_json(t.spark, path, S.BUSINESS)


@query("k3_single_csv", BUSINESS_SQL)
def single_csv(t):
    business = _business(t)["business"]
    path = scratch_path(t.spark, "k3")
    for _ in range(2):  # the second write replaces the first
        sinks.write_csv(business, path)
    return sources.read_delimited(t.spark, path, S.BUSINESS)


@query("k4_run_csv", BUSINESS_SQL)
def run_csv(t):
    base = scratch_path(t.spark, "k4")
    path = sinks.write_csv(_business(t)["business"], base, run_id="20240101_000000")
    return sources.read_delimited(t.spark, path, S.BUSINESS)


@query(
    "k5_floor_parts",
    """SELECT o_orderkey,
      least(rn // greatest(n // 10, 1), 9)::INTEGER AS part
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS rn,
            count(*) OVER () AS n FROM orders)""",
)
def floor_parts(t):
    path = scratch_path(t.spark, "k5")
    orders = t.orders.select("o_orderkey", "o_orderdate")
    sinks.write_parts(split_contiguous(orders, 10, ["o_orderdate", "o_orderkey"]), path)
    return sources.read_parquet(t.spark, path).select("o_orderkey", "part")


@query(
    "k6_ceil_parts",
    """SELECT doc_id, text, (rn // ((n + 19) // 20))::INTEGER AS part
    FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS rn,
            count(*) OVER () AS n FROM documents)""",
)
def ceil_parts(t):
    path = scratch_path(t.spark, "k6")
    documents = t.documents.select("doc_id", "text")
    parts = split_contiguous(documents, 20, ["doc_id"], mode="ceil")
    sinks.write_parts(parts, path, fmt="json")
    return sources.read_json(t.spark, path, S.table(doc_id=S.LONG, text=S.STR, part=S.INT))


@query(
    "k7_many_tables",
    with_ctes(
        inputs.STATES_SQL,
        inputs.SITES_SQL,
        inputs.kept_sites_sql(),
        body="""SELECT 'business' AS name, count(*) AS n FROM kept
    UNION ALL SELECT 'category_business', sum(len(category))::BIGINT FROM kept
    UNION ALL SELECT 'service_business', sum(len(service))::BIGINT FROM kept
    UNION ALL SELECT 'planning_busines', sum(len(planning))::BIGINT FROM kept""",
    ),
)
def many_tables(t):
    path = scratch_path(t.spark, "k7")
    tables = _business(t)
    sinks.write_all(tables, lambda name, df: df.write.parquet(f"{path}/{name}"))
    counts = None
    for name in tables:
        one = t.spark.read.parquet(f"{path}/{name}").agg(
            F.lit(name).alias("name"), F.count("*").alias("n")
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    "p8_row_positions",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx
    FROM orders""",
)
def row_positions(t):
    return with_row_index(
        t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]
    ).select("o_orderkey", "idx")
