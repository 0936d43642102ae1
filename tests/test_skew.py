"""One key holds a third of all rows: results stay whole, hot groups are split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from placemill import operators as op
from placemill import plans
from placemill import schemas as S

ROWS = 60_000


@pytest.fixture
def skewed(spark):
    """``(k, v)`` in which key 0 has a third of the rows, and settings for small data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1)
    yield spark.range(0, ROWS, 1, 16).select(hot.alias("k"), F.col("id").alias("v"))
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def final_plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def payload(df):
    """Rows with text that does not compress away."""
    return df.withColumn("text", F.md5(F.col("v").cast("string")))


@pytest.fixture
def large_keys(monkeypatch):
    """As if key sets and batches were beyond the bounds of broadcasts and of key filters."""
    monkeypatch.setattr("placemill.operators.incremental.is_small", lambda df: False)
    monkeypatch.setattr("placemill.operators.incremental.MAX_KEYS", 0)


def test_hot_key_of_a_semi_join_is_split(spark, skewed, large_keys):
    keys = spark.range(0, 100).select(F.col("id").alias("k"))
    keys = keys.unionByName(spark.range(0, 5000).select(F.lit(0).cast("long").alias("k")))
    kept = op.restrict_to(payload(skewed), keys, "k")
    rows = kept.collect()
    assert len(rows) == len({r.v for r in rows})
    assert len(rows) == skewed.filter("k < 100").count()
    assert "skew=true" in final_plan(kept)


def test_hot_copies_of_an_anti_join_are_split(spark, skewed, large_keys):
    batch = payload(skewed).withColumn("v", F.when(F.col("k") > 0, F.col("v")).otherwise(3))
    same = F.col("id") % 1
    known = spark.range(0, 40_000, 1, 16).select(same.alias("k"), (same + 3).alias("v"))
    for hit in (True, False):
        target = known if hit else known.withColumn("v", F.col("v") + 1)
        new = op.only_new(batch, target)
        rows = new.collect()
        assert len(rows) == (ROWS * 2 // 3 if hit else ROWS)
        assert "skew=true" in final_plan(new), final_plan(new)


def test_hot_cell_of_a_large_place_index_is_split(spark, skewed, monkeypatch):
    monkeypatch.setattr("placemill.operators.geo.broadcast_if_small", lambda df: df)
    points = payload(skewed).select(
        "v",
        "text",
        (F.col("k") % 50).cast("double").alias("latitude"),
        F.lit(5.0).alias("longitude"),
    )
    places = [(f"c{n}", "s", float(n), 5.1) for n in range(50)]
    placed = op.attach_place(points, spark.createDataFrame(places, S.GAZETTEER))
    wrong = placed.filter("ciudad <> concat('c', int(latitude)) OR ciudad IS NULL")
    assert wrong.count() == 0
    rows = placed.collect()
    assert len(rows) == ROWS
    assert "skew=true" in final_plan(placed)


def test_hot_key_of_a_state_join(spark, skewed):
    """A dimension too large to broadcast is joined by shuffle, the hot code split."""
    df = skewed.withColumn("code", F.col("k").cast("string"))
    dimension = spark.range(0, 300_000).selectExpr(
        "concat('n', id, ' ') AS nombre_largo", "string(id) AS nombre_corto", "'' AS codigos"
    )
    named = op.attach_state(df, dimension, "code")
    rows = named.filter("estado IS NULL OR estado <> concat('n', code)")
    assert rows.isEmpty()
    assert named.select("v", "estado").distinct().count() == ROWS


def test_hot_key_of_a_dedupe(skewed):
    first = op.dedupe_first(skewed, ["k"], [F.desc("v")], scope="global")
    want = skewed.groupBy("k").agg(F.max("v").alias("v"))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, want.collect()))


def test_hot_null_keys_of_a_dedupe(skewed):
    nulls = skewed.withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    first = op.dedupe_first(nulls, ["k"], ["v"], scope="global")
    assert first.filter("k IS NULL").collect()[0].v == 0
    assert first.count() == nulls.select("k").distinct().count()


def test_hot_item_of_the_rankings(spark, skewed):
    reviews = skewed.select(
        F.col("k").alias("game_id"),
        F.lit(True).alias("recommend"),
        F.lit(1).alias("sentiment_analysis"),
        F.lit(2015).alias("year"),
    )
    games = spark.range(0, 600).selectExpr(
        "id AS game_id", "concat('g', id) AS game_name", "'x' AS genres", "2000 AS release_year"
    )
    best = plans.top_items(reviews, games, 2015, positive=True).collect()
    assert (best[0].game_name, best[0].size) == ("g0", ROWS // 3)
    counts = plans.sentiment_counts(games, reviews, 2000).first()
    assert counts.neutral == ROWS


def test_hot_row_of_a_similarity_table(skewed):
    sims = skewed.select(
        F.col("k").alias("i"), F.col("v").alias("j"), F.col("v").cast("double").alias("sim")
    )
    top = plans.neighbours(sims, 5).filter("i = 0").orderBy("position").collect()
    assert [r.j for r in top] == [ROWS - 3 * n for n in range(2, 7)]


def test_hot_value_of_the_sort_key(skewed):
    """A third of the rows share the first sort column; positions stay dense."""
    parts = op.split_contiguous(skewed, 7, ["k", "v"]).groupBy("part").count().collect()
    assert sorted(r["count"] for r in parts) == sorted([ROWS // 7] * 6 + [ROWS - 6 * (ROWS // 7)])
    indexed = op.with_row_index(skewed, ["k", "v"])
    assert indexed.agg(F.countDistinct("idx"), F.max("idx")).first() == (ROWS, ROWS - 1)


def test_hot_place_and_hot_cell(spark, skewed):
    """Copies of one place and many points in one cell."""
    points = skewed.select(
        "v",
        (F.lit(40.0) + F.col("k") / 1000).alias("latitude"),
        (F.lit(-75.0) - F.col("k") / 1000).alias("longitude"),
    )
    copies = [("hot", "s", 40.0, -75.0)] * 500 + [("far", "s", 40.45, -75.45)]
    gazetteer = spark.createDataFrame(copies, S.GAZETTEER)
    placed = op.attach_place(points, gazetteer, max_km=100)
    assert placed.count() == ROWS
    at_hot = placed.filter("latitude = 40.0").select("ciudad").distinct().collect()
    assert [r.ciudad for r in at_hot] == ["hot"]


def test_hot_user_of_the_playtime(skewed):
    facts = skewed.select(
        F.col("k").cast("string").alias("user_id"),
        F.lit("x").alias("genres"),
        (F.col("v") % 5 + 2000).cast("int").alias("release_year"),
        F.lit(1).cast("long").alias("playtime_forever"),
    )
    top = plans.top_user(facts).collect()
    assert {r.user_id for r in top} == {"0"}
    assert sum(r.playtime_forever for r in top) == ROWS // 3
