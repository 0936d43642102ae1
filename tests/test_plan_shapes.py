"""Physical plans: what moves, what is pushed down, and what must not occur."""

from __future__ import annotations

import pytest

from placemill import operators as op
from placemill import plans
from placemill.runtime import broadcast_if_small
from suite import inputs
from suite.registry import QUERIES, Tables

FOLDER = "/root/testdata/sf0.001"
# These write files first and only read them back; their plans are plain scans.
EAGER = ("s", "k", "t1", "t2", "t3", "l2", "l3_", "l3b", "l12", "l13", "m2", "q7")


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, FOLDER)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Plan as for large inputs: no side is small enough to broadcast unasked."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if not k.startswith(EAGER)))
def test_no_pairs_and_no_python(spark, large, key):
    text = plan(QUERIES[key](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert node not in text, node


def test_dedupe_limits_groups_before_the_shuffle(t, large):
    text = plan(op.dedupe_first(t.events, ["user_id"], ["ts"], scope="global"))
    assert text.count("WindowGroupLimit") == 2
    below = text[text.rindex("Exchange") :]
    assert "Partial" in below
    assert text.count("Exchange") == 1


def test_neighbour_ranks_are_limited_before_the_shuffle(t, large):
    sims = t.lineitem.selectExpr("l_partkey AS i", "l_suppkey AS j", "l_tax AS sim")
    text = plan(plans.neighbours(sims))
    assert "row_number(), 6, Partial" in text


def test_states_are_broadcast_and_places_do_not_move(t, large):
    sites = inputs.sites(t).select("address", "gmap_id")
    text = plan(op.parse_address(sites, inputs.states(t)))
    assert "BroadcastHashJoin" in text
    # one shuffle makes the dimension unique, one broadcast sends it
    assert plan(sites).count("Exchange") + 2 == text.count("Exchange")


def test_year_filter_reaches_the_scan(t):
    text = plan(op.year_between(t.lineitem, "l_shipdate", 1997, 1999).select("l_orderkey"))
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)" in text
    assert "LessThan(l_shipdate,2000-01-01T00:00)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_millisecond_filter_reaches_the_scan(spark, t, tmp_path):
    inputs.maps_reviews(t).write.parquet(str(tmp_path / "r"))
    reviews = spark.read.parquet(str(tmp_path / "r"))
    text = plan(plans.build_maps_reviews({"reviews": reviews})["reviews"])
    assert "GreaterThanOrEqual(time,1262304000000)" in text
    assert "resp" not in text


def test_reviews_join_on_keys_only(t, large):
    tables = {"business": inputs.yelp_business(t), "states": inputs.states(t)}
    tables["reviews"] = inputs.yelp_reviews(t)
    df = plans.build_yelp_reviews(tables, order_by=["source_seq"], scope="global")["reviews"]
    assert "LeftSemi" in plan(df)


def test_sums_of_top_user_are_computed_once(t, large):
    facts = t.orders.selectExpr(
        "o_orderpriority AS genres",
        "o_custkey AS user_id",
        "year(o_orderdate) AS release_year",
        "o_orderkey AS playtime_forever",
    )
    text = plan(plans.top_user(facts))
    assert text.count("FileScan") == 1
    assert "Join" not in text


def test_reviews_are_counted_before_the_join(t, large):
    text = plan(plans.sentiment_counts(inputs.games(t), inputs.game_reviews(t), 2001))
    assert text.index("SortMergeJoin") < text.index("partial_count")
    # One exchange per side and one for the total: the join adds none.
    assert text.count("Exchange") == 3


def test_standardise_moves_no_rows(t):
    df = plans.standardise(t.part.select("p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    df.collect()
    final = plan(df).split("Subquery")[0]
    assert "Exchange" not in final


def test_position_scan_prunes_columns(t):
    text = plan(t.lineitem.select("l_orderkey").distinct())
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_broadcast_is_refused_above_the_bound(spark, large):
    left = spark.range(1000)
    assert "BroadcastHashJoin" in plan(left.join(broadcast_if_small(spark.range(10)), "id"))
    many = broadcast_if_small(spark.range(100), max_rows=99)
    assert "BroadcastHashJoin" not in plan(left.join(many, "id"))
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) AS text")
    assert "BroadcastHashJoin" not in plan(left.join(broadcast_if_small(wide, max_bytes=999), "id"))


def test_small_batches_and_key_sets_leave_the_large_side_in_place(t, large):
    target = t.lineitem.select("l_orderkey", "l_linenumber")
    text = plan(op.only_new(target.limit(10), target))
    assert "LeftSemi, BuildRight" in text and "BroadcastHashJoin" in text
    keys = t.customer.selectExpr("c_custkey AS o_custkey").filter("o_custkey < 50")
    kept = plan(op.restrict_to(t.orders.select("o_orderkey", "o_custkey"), keys, "o_custkey"))
    assert "BroadcastHashJoin" in kept and "SortMergeJoin" not in kept
