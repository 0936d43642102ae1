"""Catalogue questions and the recommender."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from placemill import plans
from placemill import schemas as S
from placemill.constants import SCALED_FEATURES
from placemill.plans.recommend import CENTRE_COLUMNS, fit_clusters


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_user_of_the_largest_single_year(spark):
    facts = [("A", "indie", 2010, 60), ("A", "indie", 2011, 50), ("B", "indie", 2012, 70)]
    facts += [("B", "indie", 2009, None), ("C", "action", 2012, 999), (None, "indie", 2012, 500)]
    df = spark.createDataFrame(facts, S.USER_GENRE)
    assert rows(plans.top_user(df, "Indie")) == [("indie", "B", 2012, 70), ("indie", "B", 2009, 0)]
    assert {r[:2] for r in rows(plans.top_user(df))} == {("indie", "B"), ("action", "C")}
    assert rows(plans.top_user(df, "none")) == []


def test_best_year(spark):
    facts = [("u", "a", 2011, 5), ("v", "a", 2010, 5), ("v", "a", 2012, 4), ("v", "b", 2000, None)]
    agg = plans.playtime_by_genre_year(spark.createDataFrame(facts, S.USER_GENRE))
    assert sorted(rows(plans.best_year(agg))) == [("a", 2010, 5), ("b", 2000, 0)]
    assert rows(plans.best_year(agg, "A")) == [("a", 2010, 5)]
    assert rows(plans.best_year(agg, "zzz")) == []


@pytest.fixture(scope="module")
def catalogue(spark):
    games = [(n, f"game {n}", g, 2010 + n % 2) for n in range(1, 6) for g in ("x", "y")]
    reviews = [(9, True, 2, 2015)] * 9  # not in the catalogue
    for game, times in {1: 3, 2: 5, 3: 5, 4: 1}.items():
        reviews += [(game, True, 1, 2015)] * times
    reviews += [(1, True, 0, 2015), (1, False, 0, 2015), (5, False, 0, 2015), (5, None, 0, 2015)]
    reviews += [(5, False, 2, 2015), (5, False, 0, 2014)]
    return (
        spark.createDataFrame(games, S.GAMES),
        spark.createDataFrame(reviews, S.GAME_REVIEWS),
    )


def test_top_items(catalogue):
    games, reviews = catalogue
    assert rows(plans.top_items(reviews, games, 2015, positive=True)) == [
        (1, 2, "game 2", 5),
        (2, 3, "game 3", 5),
        (3, 1, "game 1", 3),
    ]
    assert rows(plans.top_items(reviews, games, 2015, positive=False)) == [
        (1, 1, "game 1", 1),
        (2, 5, "game 5", 1),
    ]
    assert rows(plans.top_items(reviews, games, 1999, positive=True)) == []


def test_sentiment_counts(catalogue):
    games, reviews = catalogue
    assert rows(plans.sentiment_counts(games, reviews, 2010)) == [(0, 6, 0)]
    assert rows(plans.sentiment_counts(games, reviews, 2011)) == [(5, 8, 1)]
    assert rows(plans.sentiment_counts(games, reviews, 1999)) == [(0, 0, 0)]


def test_canonical_genre(spark):
    games = spark.createDataFrame([(1, "g", "RPG", 1), (2, "h", None, 2)], S.GAMES)
    assert rows(plans.canonical_genre(games, "rPg")) == [("RPG",)]
    assert rows(plans.canonical_genre(games, "puzzle")) == [("",)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(n + 100, f"g{n}", n) for n in range(8)], S.GAME_MODEL)


def test_similar_by_table_skips_the_first_place(spark, items):
    sims = [(2, 1, 1.0), (2, 2, 1.0)] + [(2, j, j / 10) for j in (0, 3, 4, 5, 6, 7)]
    df = spark.createDataFrame([*sims, (3, 0, 5.0)], S.SIMILARITY)
    found = rows(plans.similar_items(items, df, 102).select("position", "game_name"))
    assert found == [(1, "g2"), (2, "g7"), (3, "g6"), (4, "g5"), (5, "g4")]
    assert rows(plans.similar_items(items, df, 999)) == []


def test_similar_by_vector(spark, items):
    vectors = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0])]
    vectors += [(4, [-1.0, 0.0]), (5, [0.0, 0.0]), (6, None)]
    df = spark.createDataFrame(vectors, "idx long, embedding array<float>")
    found = rows(plans.similar_items(items, df, 101).select("position", "game_name", "sim"))
    assert [f[:2] for f in found] == [(1, "g1"), (2, "g2"), (3, "g3"), (4, "g4")]
    assert found[1][2] == pytest.approx(2**-0.5)
    assert rows(plans.similar_items(items, df, 999)) == []


def test_neighbours(spark):
    sims = [(i, j, 1.0 if j == i else 1 / (1 + abs(i - j))) for i in range(4) for j in range(9)]
    found = plans.neighbours(spark.createDataFrame(sims, S.SIMILARITY), 5)
    per_item = found.groupBy("i").agg(F.sort_array(F.collect_list("position")).alias("p"))
    assert {tuple(r.p) for r in per_item.collect()} == {(1, 2, 3, 4, 5)}
    assert found.filter("i = 0 and position = 1").first().j == 1


@pytest.fixture(scope="module")
def features(spark):
    n = F.col("id")
    raw = {c: (n * (at + 3) % 17).cast("double") for at, c in enumerate(SCALED_FEATURES)}
    raw["business_platform"] = F.lit(2.0)
    return (
        spark.range(200)
        .withColumns(raw)
        .withColumns(
            {
                "state": F.when(n < 150, "Texas").otherwise("Utah"),
                "category_name": F.lit("Pizza"),
                "latitude": 30 + n % 5 + n / 1000,
                "longitude": -90 - n % 7 + n / 500,
            }
        )
    )


def test_standardise(features):
    scaled = plans.standardise(features, SCALED_FEATURES)
    for name in SCALED_FEATURES:
        mean, deviation = scaled.agg(F.avg(name), F.stddev_pop(name)).first()
        assert mean == pytest.approx(0, abs=1e-9)
        assert deviation == pytest.approx(0 if name == "business_platform" else 1)


def test_centres_are_means_of_their_members(features):
    points, model = fit_clusters(features, CENTRE_COLUMNS, 5)
    members = model.transform(points).groupBy("cluster")
    means = members.agg(*[F.avg(c).alias(c) for c in CENTRE_COLUMNS]).collect()
    assert len(means) == 5
    for row in means:
        centre = model.clusterCenters()[row.cluster]
        assert list(row)[1:] == pytest.approx(list(centre), abs=0.05)


def test_recommended_locations(features):
    found = plans.recommend_locations(features, "Texas", "Pizza")
    assert found.columns == ["cluster", *CENTRE_COLUMNS]
    assert found.count() == 5
    raw = plans.recommend_locations(features, "Texas", "Pizza", unscale=True).collect()
    assert all(row.business_platform == pytest.approx(2.0) for row in raw)
    assert all(0 <= row.review_stars <= 17 for row in raw)
    assert all(29 <= row.latitude <= 36 for row in raw)


def test_too_few_rows_to_cluster(features):
    with pytest.raises(ValueError, match="fewer than 5"):
        plans.recommend_locations(features.filter("id < 4"), "Texas", "Pizza")
