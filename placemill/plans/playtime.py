"""Playtime per genre and year, kept up to date batch by batch.

Each batch adds its partial sums, one row for each group that it touches, as a load that
counts once. Reading adds the partial sums up; compaction puts those of many
loads into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.plans.catalogue import playtime_by_genre_year
from placemill.schemas import LONG, STR, table
from placemill.sinks.loads import committed_loads, load_once

#: Partial sums and, in compacted ones, the loads that they stand for.
PARTS = table(genres=STR, release_year=LONG, playtime_forever=LONG, covers=STR)
_COMPACT = "compact."


def add_playtime(facts: DataFrame, root: str, load_id: str) -> bool:
    """Add a batch of ``facts`` to the sums at ``root``; False if the load was there already."""
    if load_id.startswith(_COMPACT):
        raise ValueError(f"load ids do not begin with {_COMPACT}")
    sums = playtime_by_genre_year(facts).withColumn("covers", F.lit(None).cast("string"))
    return load_once(sums, root, PARTS, load_id)


def kept_playtime(spark: SparkSession, root: str) -> DataFrame:
    """The sums over all batches: the same as ``playtime_by_genre_year`` of all facts."""
    parts = _standing(spark, root, committed_loads(spark, root))
    total = F.sum("playtime_forever").alias("playtime_forever")
    return parts.groupBy("genres", "release_year").agg(total)


def compact_playtime(spark: SparkSession, root: str) -> bool:
    """Put the partial sums of all batches so far into one load; readers see one or the other.

    Batches that are added meanwhile stay as they are. False if there is nothing to put together.
    """
    loads = committed_loads(spark, root)
    covered = [name for name in loads if not name.startswith(_COMPACT)]
    done = [name for name in loads if name.startswith(_COMPACT)]
    if not covered or f"{_COMPACT}{len(covered):012d}" in done:
        return False
    parts = _standing(spark, root, loads)
    total = F.sum("playtime_forever").alias("playtime_forever")
    sums = parts.groupBy("genres", "release_year").agg(total)
    # The names of the loads are a row of their own, without a group.
    names = spark.createDataFrame([(None, None, None, " ".join(covered))], PARTS)
    sums = sums.withColumn("covers", F.lit(None).cast("string")).unionByName(names)
    return load_once(sums, root, PARTS, f"{_COMPACT}{len(covered):012d}")


def _standing(spark: SparkSession, root: str, loads: dict[str, str]) -> DataFrame:
    """Partial sums of the last compaction and of the loads that it does not cover."""
    compact = max((name for name in loads if name.startswith(_COMPACT)), default=None)
    base = spark.createDataFrame([], PARTS)
    covered: set[str] = set()
    if compact:
        base = spark.read.schema(PARTS).parquet(f"{root}/data/{loads[compact]}")
        covered = set(base.where("covers IS NOT NULL").first()["covers"].split(" "))
    rest = [
        f"{root}/data/{folder}"
        for name, folder in loads.items()
        if not name.startswith(_COMPACT) and name not in covered
    ]
    if rest:
        base = base.unionByName(spark.read.schema(PARTS).parquet(*rest))
    return base.where("covers IS NULL")
