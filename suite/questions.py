"""Catalogue questions and the location recommender."""

from __future__ import annotations

from pyspark.sql import functions as F

from placemill.constants import SCALED_FEATURES
from placemill.operators import similarity_table
from placemill.plans import (
    add_playtime,
    best_year,
    canonical_genre,
    cluster_rounds,
    compact_playtime,
    kept_playtime,
    playtime_by_genre_year,
    recommend_locations,
    sentiment_counts,
    similar_items,
    standardise,
    top_items,
    top_user,
)
from placemill.plans.recommend import CENTRE_COLUMNS, fit_clusters
from placemill.runtime import scratch_path
from suite import inputs
from suite.inputs import with_ctes
from suite.registry import query

GENRE_YEAR_SQL = """agg AS (
  SELECT genres, release_year, sum(playtime)::BIGINT AS playtime_forever
  FROM user_genre GROUP BY ALL)"""


@query(
    "q1_best_year",
    with_ctes(
        inputs.USER_GENRE_SQL,
        GENRE_YEAR_SQL,
        body="""SELECT genres, release_year, playtime_forever FROM agg
    QUALIFY row_number() OVER (
      PARTITION BY genres ORDER BY playtime_forever DESC, release_year) = 1""",
    ),
)
def year_of_most_playtime(t):
    return best_year(playtime_by_genre_year(inputs.user_genre(t)))


@query(
    "q1_best_year_of_genre",
    with_ctes(
        inputs.USER_GENRE_SQL,
        GENRE_YEAR_SQL,
        body="""SELECT genres, release_year, playtime_forever FROM agg
    WHERE genres = 'brand#12' ORDER BY playtime_forever DESC, release_year LIMIT 1""",
    ),
)
def year_of_most_playtime_of_genre(t):
    return best_year(playtime_by_genre_year(inputs.user_genre(t)), "Brand#12")


@query(
    "q1b_playtime_by_genre_year",
    with_ctes(
        inputs.USER_GENRE_SQL,
        GENRE_YEAR_SQL,
        body="SELECT genres, release_year, playtime_forever FROM agg",
    ),
)
def playtime(t):
    return playtime_by_genre_year(inputs.user_genre(t))


@query(
    "q1b_kept_playtime",
    with_ctes(
        inputs.USER_GENRE_SQL,
        GENRE_YEAR_SQL,
        body="SELECT genres, release_year::BIGINT AS release_year, playtime_forever FROM agg",
    ),
)
def kept_playtime_of_batches(t):
    """The facts arrive in four batches, one of them twice; two are put together in between."""
    path = scratch_path(t.spark, "q1b")
    facts = inputs.user_genre(t)
    batch = F.pmod(F.xxhash64("user_id"), F.lit(4))
    for number in (0, 1, 1, 2, 3):
        add_playtime(facts.filter(batch == number), path, f"batch-{number}")
        if number == 1:
            compact_playtime(t.spark, path)
    return kept_playtime(t.spark, path)


TOP_USER_SQL = """sums AS (
  SELECT genres, user_id, release_year, sum(playtime)::BIGINT AS playtime_forever
  FROM user_genre GROUP BY ALL),
winners AS (
  SELECT genres, user_id FROM sums QUALIFY row_number() OVER (
    PARTITION BY genres ORDER BY playtime_forever DESC, user_id, release_year) = 1)"""


@query(
    "q2_top_user",
    with_ctes(
        inputs.USER_GENRE_SQL,
        TOP_USER_SQL,
        body="""SELECT genres, user_id, release_year, playtime_forever
    FROM sums JOIN winners USING (genres, user_id)""",
    ),
)
def user_with_most_playtime(t):
    return top_user(inputs.user_genre(t))


@query(
    "q2_top_user_of_genre",
    with_ctes(
        inputs.USER_GENRE_SQL,
        TOP_USER_SQL,
        body="""SELECT genres, user_id, release_year, playtime_forever
    FROM sums JOIN winners USING (genres, user_id) WHERE genres = 'brand#3'""",
    ),
)
def user_with_most_playtime_of_genre(t):
    return top_user(inputs.user_genre(t), "BRAND#3")


def _top_items_sql(opinion: str) -> str:
    return with_ctes(
        inputs.GAME_REVIEWS_SQL,
        body=f"""SELECT row_number() OVER (ORDER BY size DESC, game_id)::INTEGER AS position,
      game_id, p_name || ' ' || p_partkey AS game_name, size
    FROM (SELECT game_id, count(*) AS size FROM game_reviews
          WHERE {opinion} AND year = 1998 GROUP BY game_id)
    JOIN part ON game_id = p_partkey ORDER BY size DESC, game_id LIMIT 3""",
    )


@query("q3_most_recommended", _top_items_sql("recommend AND sentiment > 0"))
def most_recommended(t):
    return top_items(inputs.game_reviews(t), inputs.games(t), 1998, positive=True)


@query("q4_least_recommended", _top_items_sql("NOT recommend AND sentiment = 0"))
def least_recommended(t):
    return top_items(inputs.game_reviews(t), inputs.games(t), 1998, positive=False)


@query("o4_top_three", _top_items_sql("recommend AND sentiment > 0"))
def top_three(t):
    best = top_items(inputs.game_reviews(t), inputs.games(t), 1998, positive=True, k=3)
    return best.select("position", "game_id", "game_name", "size")


@query(
    "q5_sentiment_counts",
    with_ctes(
        inputs.GAME_REVIEWS_SQL,
        body="""SELECT count(*) FILTER (sentiment = 0) AS negative,
      count(*) FILTER (sentiment = 1) AS neutral, count(*) FILTER (sentiment = 2) AS positive
    FROM game_reviews JOIN part ON game_id = p_partkey WHERE p_size + 1990 = 2001""",
    ),
)
def sentiments(t):
    return sentiment_counts(inputs.games(t), inputs.game_reviews(t), 2001)


@query(
    "q6_similar_by_vector",
    """WITH own AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 42),
    scored AS (
      SELECT vec_id, list_cosine_similarity(embedding::DOUBLE[], e) AS sim
      FROM embeddings CROSS JOIN own),
    ranked AS (
      SELECT vec_id, sim, row_number() OVER (ORDER BY sim DESC, vec_id) AS rank FROM scored)
    SELECT (rank - 1)::INTEGER AS position, vec_id + 1000 AS game_id,
      'item ' || vec_id AS game_name, round(sim, 5) AS sim FROM ranked WHERE rank BETWEEN 2 AND 6""",
)
def similar_by_vector(t):
    found = similar_items(inputs.game_model(t), inputs.vectors(t), 1042)
    return found.withColumn("sim", F.round("sim", 5))


@query(
    "q6_similar_by_table",
    with_ctes(
        inputs.SIMILARITY_SQL,
        body="""SELECT (rank - 1)::INTEGER AS position, s_suppkey + 1000 AS game_id,
      s_name AS game_name, sim
    FROM (SELECT j, sim, row_number() OVER (ORDER BY sim DESC, j) AS rank FROM sims WHERE i = 7)
    JOIN supplier ON j = s_suppkey WHERE rank BETWEEN 2 AND 6""",
    ),
)
def similar_by_table(t):
    items = t.supplier.select(
        (F.col("s_suppkey") + 1000).alias("game_id"),
        F.col("s_name").alias("game_name"),
        F.col("s_suppkey").alias("idx"),
    )
    return similar_items(items, inputs.similarity(t), 1007)


@query(
    "x10_canonical_genre",
    "SELECT coalesce(min(p_type), '') AS genre FROM part WHERE lower(p_type) = 'economy'",
)
def spelling_of_genre(t):
    return canonical_genre(inputs.games(t), "eCoNoMy")


@query(
    "m1_standardise",
    with_ctes(
        inputs.FEATURES_SQL,
        body="SELECT latitude, longitude, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 5)"
            f" AS {c}"
            for c in SCALED_FEATURES
        )
        + " FROM features",
    ),
)
def standardised(t):
    scaled = standardise(inputs.location_features(t), SCALED_FEATURES)
    # Adding 0.0 turns a negative zero into zero.
    rounded = {c: F.round(c, 5) + F.lit(0.0) for c in SCALED_FEATURES}
    return scaled.select("latitude", "longitude", *SCALED_FEATURES).withColumns(rounded)


@query("m2_cluster_sizes")
def cluster_sizes(t):
    """Sizes and mean coordinates of the clusters found in all standardised rows."""
    scaled = standardise(inputs.location_features(t), SCALED_FEATURES)
    points, model = fit_clusters(scaled, CENTRE_COLUMNS)
    return (
        model.transform(points)
        .groupBy("cluster")
        .agg(
            F.count("*").alias("size"),
            F.avg("latitude").alias("latitude"),
            F.avg("longitude").alias("longitude"),
        )
    )


@query("q7_recommended_locations")
def recommended_locations(t):
    return recommend_locations(inputs.location_features(t), "Texas", "BUILDING", unscale=True)


def _rounds_sql(where: str, rounds: int, k: int = 5) -> list[str]:
    """The clustering of ``placemill.plans.rounds`` as one common table after the other."""
    xs = [f"x{at}" for at in range(len(CENTRE_COLUMNS))]
    scaled = ", ".join(
        c
        if c not in SCALED_FEATURES
        else f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}"
        for c in CENTRE_COLUMNS
    )
    grid = ", ".join(
        f"floor({c} * 1000000 + 0.5::DOUBLE)::BIGINT AS {x}" for c, x in zip(CENTRE_COLUMNS, xs)
    )
    apart = " + ".join(f"(p.{x} - c.{x}) * (p.{x} - c.{x})" for x in xs)
    columns = ", ".join(xs)
    tables = [
        f"scaled AS (SELECT {scaled} FROM features {where})",
        f"points AS (SELECT {grid} FROM scaled)",
        f"seed0 AS (SELECT 0 AS no, {columns} FROM points ORDER BY {columns} LIMIT 1)",
    ]
    for at in range(1, k):
        so_far = " UNION ALL ".join(f"SELECT * FROM seed{n}" for n in range(at))
        tables.append(
            f"""seed{at} AS (SELECT {at} AS no, {columns} FROM (
      SELECT p.*, (SELECT min({apart}) FROM ({so_far}) c) AS far FROM points p)
      ORDER BY far DESC, {columns} LIMIT 1)"""
        )
    tables.append(
        "centres0 AS (" + " UNION ALL ".join(f"SELECT *, 0 AS size FROM seed{n}" for n in range(k)) + ")"
    )
    for at in range(rounds):
        means = ", ".join(f"coalesce(floor(s.{x}::DOUBLE / s.size)::BIGINT, c.{x}) AS {x}" for x in xs)
        sums = ", ".join(f"sum({x})::BIGINT AS {x}" for x in xs)
        tables.append(
            f"""sums{at} AS (SELECT no, count(*) AS size, {sums} FROM (
      SELECT p.*, (SELECT arg_min(c.no, ({apart}) * {k}::HUGEINT + c.no) FROM centres{at} c) AS no
      FROM points p) GROUP BY no)"""
        )
        tables.append(
            f"""centres{at + 1} AS (SELECT c.no, {means}, coalesce(s.size, 0) AS size
      FROM centres{at} c LEFT JOIN sums{at} s ON c.no = s.no)"""
        )
    return tables


def _centres_sql(rounds: int) -> str:
    out = ", ".join(f"x{at}::DOUBLE / 1000000 AS {c}" for at, c in enumerate(CENTRE_COLUMNS))
    return f"SELECT no AS cluster, {{size}}{out} FROM centres{rounds}"


@query(
    "m2_cluster_rounds",
    with_ctes(
        inputs.FEATURES_SQL, *_rounds_sql("", 4), body=_centres_sql(4).format(size="size, ")
    ),
)
def cluster_of_rounds(t):
    """Four rounds over all standardised rows."""
    scaled = standardise(inputs.location_features(t), SCALED_FEATURES)
    return cluster_rounds(scaled, CENTRE_COLUMNS, rounds=4)


@query(
    "q7_recommended_by_rounds",
    with_ctes(
        inputs.FEATURES_SQL,
        *_rounds_sql("WHERE state = 'Texas' AND category_name = 'BUILDING'", 4),
        body=_centres_sql(4).format(size=""),
    ),
)
def recommended_by_rounds(t):
    return recommend_locations(inputs.location_features(t), "Texas", "BUILDING", rounds=4)


@query("s7_nearest_items")
def nearest_items(t):
    """The similarity table of all items, made from their vectors."""
    return similarity_table(inputs.vectors(t), 5)
