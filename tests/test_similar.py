"""The similarity table against exact search, and the clustering against plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from placemill import operators as op
from placemill import plans
from placemill.operators import similar

FOLDER = "/root/testdata/sf0.01"


def exact(ids, matrix, k):
    """Ids and similarities of the k nearest others, ties to the smaller id."""
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    cosines = unit @ unit.T
    out = {}
    for at, key in enumerate(ids):
        order = sorted(
            (other for other in range(len(ids)) if other != at),
            key=lambda other: (-round(cosines[at, other], 12), ids[other]),
        )
        out[key] = [(ids[other], cosines[at, other]) for other in order[:k]]
    return out


def found(df):
    out = {}
    for row in df.collect():
        out.setdefault(row.i, []).append((row.j, row.sim))
    return {key: sorted(rows, key=lambda one: (-one[1], one[0])) for key, rows in out.items()}


@pytest.fixture(scope="module")
def items(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    return df.select(F.col("vec_id").alias("idx"), "embedding")


def test_recall_against_exact_search(items):
    rows = items.orderBy("idx").collect()
    want = exact([r.idx for r in rows], np.array([r.embedding for r in rows], float), 5)
    got = found(op.similarity_table(items, 5))
    assert set(got) == set(want) and all(len(one) == 5 for one in got.values())
    hits = [len({j for j, _ in got[key]} & {j for j, _ in want[key]}) for key in want]
    assert sum(hits) >= 0.9 * 5 * len(want)
    sims = {key: {j: sim for j, sim in exact_rows} for key, exact_rows in want.items()}
    for key, one in got.items():
        assert all(math.isclose(sim, sims[key][j], abs_tol=1e-9) for j, sim in one if j in sims[key])


@pytest.mark.parametrize("block", [4096, 16])
def test_all_lists_give_the_exact_table(spark, monkeypatch, block):
    """Clusters, a third of equal vectors, scaled copies, and rows without a direction."""
    monkeypatch.setattr(similar, "BLOCK_ROWS", block)
    draw = np.random.default_rng(3)
    middles = draw.standard_normal((6, 8))
    matrix = middles[draw.integers(0, 6, 150)] + draw.standard_normal((150, 8)) / 5
    matrix[:50] = matrix[0]
    rows = [(int(key), [float(x) for x in one]) for key, one in enumerate(matrix)]
    odd = [(900, None), (901, [0.0] * 8), (902, [1.0, None] * 4)]
    df = spark.createDataFrame(rows + odd, "idx long, embedding array<double>")
    df = df.select("*", F.lit("own").alias("sim"), F.lit("own").alias("class"))
    want = exact(list(range(150)), matrix, 4)
    got = found(op.similarity_table(df, 4, lists=9, probes=9))
    assert set(got) == set(range(150))
    for key in want:
        assert [j for j, _ in got[key]] == [j for j, _ in want[key]], key


def test_a_vector_travels_no_oftener_in_a_larger_table(spark):
    """Vectors without structure, all lists searched: a row for each block on either side."""
    draw = np.random.default_rng(9)
    for count in (300, 2400):
        rows = [(at, [float(x) for x in one]) for at, one in enumerate(draw.standard_normal((count, 6)))]
        df = spark.createDataFrame(rows, "idx long, embedding array<double>")
        members = similar._members(df, "idx", "embedding", "bigint").select("class", "vector")
        centres = similar._centres(similar._sample(members, count), math.ceil(count**0.5))
        met = similar._blocks(members, centres, len(centres), count)
        assert met.count() <= 2 * similar.BLOCKS * count
        points = met.where("point").groupBy("a", "b").count().collect()
        assert max(row["count"] for row in points) <= 2 * count / similar.BLOCKS


def test_clusters_need_few_lists():
    draw = np.random.default_rng(5)
    middles = draw.standard_normal((30, 16)) * 3
    sample = middles[draw.integers(0, 30, 2000)] + draw.standard_normal((2000, 16)) / 5
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    centres = similar._centres(sample, 40)
    assert similar._probes_for(sample, centres, 5, 0.95) <= 10
    noise = draw.standard_normal((2000, 16))
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    assert similar._probes_for(noise, similar._centres(noise, 40), 5, 0.95) > 10


def test_few_or_no_vectors(spark):
    schema = "idx long, embedding array<float>"
    assert op.similarity_table(spark.createDataFrame([], schema)).count() == 0
    assert op.similarity_table(spark.createDataFrame([(1, [1.0])], schema)).count() == 0
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], schema)
    assert found(op.similarity_table(two, 5)) == {1: [(2, 0.0)], 2: [(1, 0.0)]}
    with pytest.raises(ValueError, match="k of 1"):
        op.similarity_table(two, 0)


def rounds_by_hand(points, k, rounds):
    def apart(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    centres = [min(points)]
    while len(centres) < k:
        centres.append(min(points, key=lambda p: (-min(apart(p, c) for c in centres), p)))
    sizes = [0] * k
    for _ in range(rounds):
        groups = [[] for _ in centres]
        for p in points:
            groups[min(range(k), key=lambda at: (apart(p, centres[at]), at))].append(p)
        sizes = [len(group) for group in groups]
        moved = [
            tuple(math.floor(sum(axis) / len(group)) for axis in zip(*group, strict=True)) if group else c
            for group, c in zip(groups, centres, strict=True)
        ]
        if moved == centres:
            break
        centres = moved
    return [(at, size, *[x / 1_000_000 for x in c]) for at, (size, c) in enumerate(zip(sizes, centres, strict=True))]


@pytest.mark.parametrize("rounds", [1, 3, 300])
def test_rounds(spark, rounds):
    draw = np.random.default_rng(1)
    values = [(float(a), float(b)) for a, b in np.round(draw.standard_normal((200, 2)), 2)]
    values += values[:70]
    points = [tuple(math.floor(x * 1_000_000 + 0.5) for x in one) for one in values]
    df = spark.createDataFrame([*values, (None, 1.0)], "a double, b double").repartition(7)
    want = rounds_by_hand(points, 4, rounds)
    for again in (df, df.orderBy("b")):
        got = plans.cluster_rounds(again, ["a", "b"], 4, rounds=rounds)
        assert [tuple(row) for row in got.orderBy("cluster").collect()] == want


def test_rounds_of_few_or_equal_points(spark):
    df = spark.createDataFrame([(1.0,)] * 3, "a double")
    got = plans.cluster_rounds(df, ["a"], 2).orderBy("cluster").collect()
    assert [tuple(r) for r in got] == [(0, 3, 1.0), (1, 0, 1.0)]
    with pytest.raises(ValueError, match="fewer than 4"):
        plans.cluster_rounds(df, ["a"], 4)
