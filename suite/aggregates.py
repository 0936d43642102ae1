"""Aggregations, profiles, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from placemill.operators import (
    first_rows,
    null_counts,
    profile,
    row_range,
    value_counts,
)
from placemill.plans import neighbours
from placemill.plans.recommend import column_stats
from suite import inputs
from suite.inputs import with_ctes
from suite.registry import query


@query(
    "a1_group_count",
    "SELECT user_id, count(*) AS size FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
)
def group_count(t):
    events = t.events.dropna(subset=["user_id"])
    return events.groupBy("user_id").agg(F.count("*").alias("size"))


@query(
    "a2_group_sum",
    with_ctes(
        inputs.USER_GENRE_SQL,
        body="""SELECT user_id, release_year, coalesce(sum(playtime), 0)::BIGINT AS playtime
    FROM user_genre GROUP BY ALL""",
    ),
)
def group_sum(t):
    facts = inputs.user_genre(t).dropna(subset=["user_id", "release_year"])
    total = F.coalesce(F.sum("playtime_forever"), F.lit(0)).alias("playtime")
    return facts.groupBy("user_id", "release_year").agg(total)


@query(
    "a3_value_counts",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT address, count(*) AS count FROM sites
    WHERE address IS NOT NULL GROUP BY address""",
    ),
)
def frequencies(t):
    return value_counts(inputs.sites(t), "address")


@query("a4_distinct_values", "SELECT DISTINCT p_type AS genres FROM part")
def distinct_values(t):
    return t.part.select(F.col("p_type").alias("genres")).distinct()


@query(
    "a5_null_counts",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT count(*) FILTER (gmap_id IS NULL) AS gmap_id,
      count(*) FILTER (address IS NULL) AS address,
      count(*) FILTER (category IS NULL) AS category,
      count(*) FILTER (price IS NULL) AS price FROM sites""",
    ),
)
def nulls(t):
    return null_counts(inputs.sites(t).select("gmap_id", "address", "category", "price"))


@query(
    "a6_profile",
    with_ctes(
        inputs.SITES_SQL,
        body="""SELECT 'address' AS "column", 'string' AS dtype, count(address) AS non_null,
      count(*) - count(address) AS nulls, count(*) AS row_count FROM sites
    UNION ALL SELECT 'category', 'array<string>', count(category),
      count(*) - count(category), count(*) FROM sites
    UNION ALL SELECT 'latitude', 'double', count(latitude),
      count(*) - count(latitude), count(*) FROM sites""",
    ),
)
def table_profile(t):
    return profile(inputs.sites(t).select("address", "category", "latitude"))


@query(
    "a7_exists_in_target",
    """SELECT c_custkey, count(o_orderkey) > 0 AS present
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'
    GROUP BY c_custkey""",
)
def exists_in_target(t):
    known = t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("c_custkey")
    )
    known = known.distinct().withColumn("present", F.lit(True))
    return (
        t.customer.select("c_custkey")
        .join(known, "c_custkey", "left")
        .fillna({"present": False})
    )


@query(
    "a8_class_counts",
    """SELECT count(*) FILTER (quality = 0) AS negative, count(*) FILTER (quality = 1) AS neutral,
      count(*) FILTER (quality = 2) AS positive FROM labels""",
)
def class_counts(t):
    classes = {"negative": 0, "neutral": 1, "positive": 2}
    return t.labels.agg(
        *[F.count_if(F.col("quality") == value).alias(name) for name, value in classes.items()]
    )


@query(
    "a9_mean_and_deviation",
    """SELECT round(avg(p_size), 6) AS p_size_mean, round(stddev_pop(p_size), 6) AS p_size_scale,
      round(avg(p_retailprice), 6) AS p_retailprice_mean,
      round(stddev_pop(p_retailprice), 6) AS p_retailprice_scale FROM part""",
)
def mean_and_deviation(t):
    stats = column_stats(t.part, ["p_size", "p_retailprice"])
    return stats.select(*[F.round(name, 6).alias(name) for name in stats.columns])


@query("a10_row_total", "SELECT count(*) AS n FROM lineitem")
def row_total(t):
    return t.lineitem.agg(F.count("*").alias("n"))


# ---- sorts, limits and ranges ---------------------------------------------------------


@query("o1_by_measure", "SELECT l_partkey, count(*) AS size FROM lineitem GROUP BY l_partkey")
def by_measure(t):
    counts = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("size"))
    return counts.orderBy(F.desc("size"), "l_partkey")


@query(
    "o2_by_key",
    with_ctes(
        inputs.GAME_REVIEWS_SQL,
        body="""SELECT sentiment AS sentiment_analysis, count(*) AS size FROM game_reviews
    GROUP BY ALL ORDER BY 1""",
    ),
)
def by_key(t):
    reviews = inputs.game_reviews(t)
    counts = reviews.groupBy("sentiment_analysis").agg(F.count("*").alias("size"))
    return counts.orderBy("sentiment_analysis")


@query(
    "o5_first_of_sorted",
    """SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey,
      max(o_totalprice) AS o_totalprice FROM orders GROUP BY o_custkey""",
)
def first_of_sorted(t):
    best = F.max_by(
        F.struct("o_orderkey", "o_totalprice"), F.struct("o_totalprice", -F.col("o_orderkey"))
    )
    return t.orders.groupBy("o_custkey").agg(best.alias("best")).select("o_custkey", "best.*")


@query(
    "o6_neighbours",
    with_ctes(
        inputs.SIMILARITY_SQL,
        body="""SELECT i, j, sim, (rank - 1)::INTEGER AS position FROM (
      SELECT *, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS rank FROM sims)
    WHERE rank BETWEEN 2 AND 6""",
    ),
)
def rank_neighbours(t):
    return neighbours(inputs.similarity(t), 5)


@query(
    "o7_first_rows_per_file",
    """SELECT source, doc_id FROM documents
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5""",
)
def first_rows_per_file(t):
    return first_rows(t.documents.select("source", "doc_id"), ["source"], ["doc_id"], 5)


@query(
    "o7_first_rows",
    "SELECT doc_id, text FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10",
)
def first_rows_overall(t):
    return t.documents.orderBy(F.desc("n_chars"), "doc_id").limit(10).select("doc_id", "text")


@query(
    "o8_row_range",
    """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice, o_orderkey LIMIT 2500 OFFSET 1000""",
)
def rows_in_range(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return row_range(orders, ["o_totalprice", "o_orderkey"], 1000, 3500)
