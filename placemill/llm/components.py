"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm.shared import stored
from placemill.operators.spread import spread_join

#: Rounds halve the distance to the smallest id at least; 64-bit ids need no more.
MAX_ROUNDS = 200


def _linked_to_least(near: DataFrame, least: DataFrame) -> DataFrame:
    """For the rows (u, v) of ``near``, v with the smallest id around u."""
    return spread_join(near, least, ["u"], "inner")


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than u is linked to the smallest of u and its neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = _linked_to_least(both.where("v > u"), least)
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = _linked_to_least(down, least)
    moved = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionAll(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long), component the least id.

    Each round is two grouped minima and two joins on a node; a hub is split by the
    join, not gathered. Links of a node to itself are dropped, so a node with no other
    link has no row. No edges: no rows. Raises if the links have not settled after
    ``MAX_ROUNDS`` rounds, which no graph of 64-bit ids needs.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.distinct(), "edges")
    mark = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")))
    before = edges.select(mark).first()[0]
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        edges = stored(small_star(large_star(edges)), "edges")
        now = edges.select(mark).first()[0]
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
