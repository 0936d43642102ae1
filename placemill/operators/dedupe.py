"""Deduplication with a defined survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill.sources.readers import POSITION


def first_rows(
    df: DataFrame, keys: Sequence[str], order_by: Sequence, n: int = 1
) -> DataFrame:
    """The first ``n`` rows of every key under ``order_by``.

    Spark turns the rank filter into a group limit that runs before the shuffle,
    so each map task sends at most ``n`` rows of a key, however hot the key is.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def dedupe_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence = POSITION,
    *,
    scope: str = "file",
) -> DataFrame:
    """The first row of every key; rows with a null key count as one key.

    ``scope="file"`` works inside each input file and needs the position columns
    of ``read_many``; ``scope="global"`` works over all rows.
    """
    if scope not in ("file", "global"):
        raise ValueError(f"unknown scope: {scope}")
    per_file = [POSITION[0]] if scope == "file" else []
    return first_rows(df, [*per_file, *keys], order_by)
