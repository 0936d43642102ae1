"""Key filters and the incremental join that uses them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from placemill import operators as op
from placemill.operators import keyfilter
from placemill.operators.keyfilter import bits_for, maybe_among


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_size_of_a_filter():
    assert bits_for(0) == bits_for(2048) == keyfilter.ROW_BITS
    assert bits_for(2049) == 2 * keyfilter.ROW_BITS
    assert bits_for(10_000_000) == bits_for(10**12) == keyfilter.MAX_BITS


@pytest.mark.parametrize("count", [0, 1, 50_000])
def test_every_key_passes_and_few_others(spark, count):
    keys = spark.range(count).select((F.col("id") * 3).alias("a"), F.lit("x").alias("b"))
    rows = spark.range(200_000).select(
        F.col("id").alias("a"), F.lit("x").alias("b"), *[F.lit(1).alias(c) for c in ("place", "_byte")]
    )
    kept = maybe_among(rows, keys, ["a", "b"], keys=count)
    assert kept.columns == rows.columns
    found = {r.a for r in kept.select("a").collect()}
    real = {3 * at for at in range(count)} & set(range(200_000))
    assert real <= found
    assert len(found - real) <= 200_000 / keyfilter.BITS_PER_KEY


def test_null_keys_go_and_copies_stay(spark):
    rows = spark.createDataFrame([(1, None), (None, 2), (1, 2), (1, 2)], "a int, b int")
    assert [tuple(r) for r in maybe_among(rows, rows, ["a", "b"], keys=4).collect()] == [(1, 2)] * 2


@pytest.mark.parametrize("bound", [keyfilter.MAX_KEYS, 0])
def test_a_batch_beyond_the_broadcast_bound(spark, monkeypatch, bound):
    monkeypatch.setattr("placemill.operators.incremental.is_small", lambda df: False)
    monkeypatch.setattr("placemill.operators.incremental.MAX_KEYS", bound)
    batch = spark.range(3000).select(
        F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"),
        (F.col("id") % 7).alias("v"),
        F.lit("new").alias("text"),
    )
    target = spark.range(0, 100_000, 2).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("v"), F.lit("old").alias("text")
    )
    new = op.only_new(batch, target)
    rows = new.collect()
    assert len(rows) == 300 + 1500
    assert all(r.k is None or r.k % 2 == 1 for r in rows)
    assert ("bitmap_construct_agg" in final_plan(new)) == (bound > 0)


def test_a_small_batch_is_not_shuffled(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    target = items.select("l_orderkey", "l_linenumber", F.lit("t").alias("text"))
    line = F.expr("CASE WHEN l_linenumber > 3 THEN -l_linenumber ELSE l_linenumber END")
    batch = target.where("l_orderkey < 500").withColumn("l_linenumber", line)
    new = op.only_new(batch, target)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 2
    # The only exchange by keys is that of the target rows that are known.
    assert plan.count("Exchange hashpartitioning") == 1
    assert new.count() == batch.where("l_linenumber < 0").count() > 0
