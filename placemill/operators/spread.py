"""Equality joins that stay splittable when a key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """``left.join(right, on, how)`` where ``right`` is already grouped by ``on``.

    Adaptive execution splits a skewed partition only if both sides were shuffled
    for the join. A right side that was aggregated on the join keys would be used
    as it lies. Joining on a hash of the keys as well changes no result, but gives
    the join shuffles of its own, so the rows of a hot key can go to many tasks.
    """
    exact = [name for name in on if not isinstance(left.schema[name].dataType, FractionalType)]
    if not exact:
        return left.join(right, list(on), how)
    code, name = F.xxhash64(*exact), "_spread"
    taken = {own.lower() for own in (*left.columns, *right.columns)}
    while name in taken:
        name = "_" + name
    sides = left.withColumn(name, code), right.withColumn(name, code)
    return sides[0].join(sides[1], [*on, name], how).drop(name)
