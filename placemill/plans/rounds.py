"""A clustering with one possible result: fixed seeds, exact sums, a stated tie rule.

Coordinates are whole numbers on a grid, so sums and squared distances are exact and
do not depend on the order of rows. The first centre is the smallest point, each next one
the point farthest from the centres so far (the smallest of several). Then rounds of
assignment, ties to the centre with the smaller number, and means rounded down, until the
centres rest. A round is one grouped sum; the driver holds the centres only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.runtime import cut_lineage

GRID = 1_000_000  # whole numbers in one unit


def cluster_rounds(
    df: DataFrame, cols: Sequence[str], k: int = 5, *, rounds: int = 300
) -> DataFrame:
    """``cluster`` (from 0), ``size`` and the centre's coordinates, on the grid, of each cluster.

    Rows with a null in ``cols`` are left out; fewer than ``k`` others are an error. A cluster
    that loses all its points keeps its centre, with size 0. Sums beyond 64 bits are an error:
    values should be scaled to some thousands at most. ``rounds`` bounds the rounds.
    """
    names = [f"x{at}" for at in range(len(cols))]
    on_grid = [
        F.floor(F.col(c) * GRID + 0.5).cast("long").alias(x) for c, x in zip(cols, names, strict=True)
    ]
    points = cut_lineage(df.dropna(subset=list(cols)).select(*on_grid))
    if points.limit(k).count() < k:
        raise ValueError(f"fewer than {k} rows to cluster")
    centres = [tuple(points.agg(F.min(F.struct(*names))).first()[0])]
    while len(centres) < k:
        nearest = reduce(F.least, [_distance(names, one) for one in centres])
        far = points.agg(F.min(F.struct((-nearest).alias("down"), *names))).first()[0]
        centres.append(tuple(far)[1:])
    sizes = [0] * k
    for _ in range(rounds):
        sums = points.groupBy(_number(names, centres).alias("cluster")).agg(
            F.count(F.lit(1)).alias("size"), *[F.sum(x).alias(x) for x in names]
        )
        moved, sizes = list(centres), [0] * k
        for row in sums.select(
            "cluster", "size", *[F.floor(F.col(x).cast("double") / F.col("size")).alias(x) for x in names]
        ).collect():  # a row for each cluster
            sizes[row["cluster"]] = row["size"]
            moved[row["cluster"]] = tuple(row[x] for x in names)
        if moved == centres:
            break
        centres = moved
    rows = [
        (at, size, *[x / GRID for x in one])
        for at, (size, one) in enumerate(zip(sizes, centres, strict=True))
    ]
    schema = "cluster int, size long, " + ", ".join(f"`{name}` double" for name in cols)
    return df.sparkSession.createDataFrame(rows, schema)


def _distance(names: Sequence[str], centre: Sequence[int]) -> Column:
    parts = [F.col(x) - F.lit(value).cast("long") for x, value in zip(names, centre, strict=True)]
    return reduce(Column.__add__, [part * part for part in parts])


def _number(names: Sequence[str], centres: Sequence[tuple]) -> Column:
    """The number of the nearest centre."""
    ranked = [
        F.struct(_distance(names, one).alias("far"), F.lit(at).alias("at")) for at, one in enumerate(centres)
    ]
    return F.array_min(F.array(*ranked))["at"]
