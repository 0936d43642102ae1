"""Recommended locations: standardise the features of places and cluster them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.constants import SCALED_FEATURES
from placemill.plans.rounds import cluster_rounds

CENTRE_COLUMNS = ("latitude", "longitude", *SCALED_FEATURES)
MAX_ITERATIONS = 300  # a bound only: iterations stop when the centres rest


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with ``<col>_mean`` and ``<col>_scale`` per column.

    The scale is the population deviation, or 1 for a constant column.
    """
    pairs = []
    for name in cols:
        spread = F.coalesce(F.nullif(F.stddev_pop(name), F.lit(0.0)), F.lit(1.0))
        pairs += [F.avg(name).alias(f"{name}_mean"), spread.alias(f"{name}_scale")]
    return df.agg(*pairs)


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Shift and scale columns to mean 0 and population deviation 1.

    The statistics are one scalar subquery, so this is a second pass over the
    rows but moves none of them.
    """
    stats = column_stats(df, cols)
    found = stats.select(F.struct(*stats.columns)).scalar()
    return (
        df.withColumn("_stats", found)
        .withColumns(
            {c: (F.col(c) - F.col(f"_stats.{c}_mean")) / F.col(f"_stats.{c}_scale") for c in cols}
        )
        .drop("_stats")
    )


def fit_clusters(
    df: DataFrame,
    cols: Sequence[str],
    k: int = 5,
    seed: int = 42,
    max_iterations: int = MAX_ITERATIONS,
) -> tuple[DataFrame, KMeansModel]:
    """Rows with a vector column ``features``, and the k-means model fitted to it.

    ``model.summary.numIter`` tells how many of ``max_iterations`` the fit took.
    """
    if df.limit(k).count() < k:
        raise ValueError(f"fewer than {k} rows to cluster")
    points = VectorAssembler(inputCols=list(cols), outputCol="features").transform(df)
    estimator = KMeans(
        k=k, seed=seed, maxIter=max_iterations, featuresCol="features", predictionCol="cluster"
    )
    return points, estimator.fit(points)


def cluster(df: DataFrame, cols: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """The ``k`` cluster centres: ``cluster`` and one column per feature."""
    _, model = fit_clusters(df, cols, k, seed)
    centres = [(at, *map(float, c)) for at, c in enumerate(model.clusterCenters())]
    schema = "cluster int, " + ", ".join(f"`{name}` double" for name in cols)
    return df.sparkSession.createDataFrame(centres, schema)


def recommend_locations(
    features: DataFrame,
    state: str,
    category: str,
    k: int = 5,
    *,
    unscale: bool = False,
    rounds: int | None = None,
) -> DataFrame:
    """``k`` recommended locations for a state and a category.

    The scaled features of the matching places are clustered with their raw
    coordinates. The result has the centres, in scaled units unless ``unscale``. With
    ``rounds`` the centres come from that many rounds at most of ``cluster_rounds``, which has one
    possible result, instead of k-means with random seeds.
    """
    chosen = features.filter((F.col("state") == state) & (F.col("category_name") == category))
    scaled = standardise(chosen, SCALED_FEATURES)
    if rounds is None:
        centres = cluster(scaled, CENTRE_COLUMNS, k)
    else:
        centres = cluster_rounds(scaled, CENTRE_COLUMNS, k, rounds=rounds).drop("size")
    if not unscale:
        return centres
    stats = column_stats(chosen, SCALED_FEATURES)
    found = stats.select(F.struct(*stats.columns)).scalar()
    raw = {
        c: F.col(c) * F.col(f"_stats.{c}_scale") + F.col(f"_stats.{c}_mean")
        for c in SCALED_FEATURES
    }
    return centres.withColumn("_stats", found).withColumns(raw).drop("_stats")
