"""Joins against rows that are already loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.operators.keyfilter import MAX_KEYS, maybe_among
from placemill.operators.spread import spread_join
from placemill.runtime import BROADCAST_ROWS, is_small


def restrict_to(df: DataFrame, keys_df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df``; null matches nothing.

    Keys are made distinct before they move, so copies of one key cost nothing.
    A key set within the broadcast bound leaves ``df`` where it lies.
    """
    on = [on] if isinstance(on, str) else list(on)
    keys = keys_df.select(*on).distinct()
    if is_small(keys):
        return df.join(F.broadcast(keys), on, "left_semi")
    return spread_join(df, keys, on, "left_semi")


def only_new(
    batch: DataFrame,
    target: DataFrame,
    *,
    ignore: Sequence[str] = ("text",),
    prune_on: str | None = None,
) -> DataFrame:
    """Rows of ``batch`` that equal no target row on all columns but ``ignore``.

    Null equals nothing, so a row with a null key is always new. Duplicates
    inside the batch stay. ``prune_on`` names a column whose range in the batch
    (one small query) limits the part of the target that is scanned.

    A batch within the broadcast bound is not shuffled, and of the target no more
    than its keys' rows are. Of a larger batch a bitmap of its key hashes goes to the
    target scan, and only target rows that pass it move, until the batch has more
    than ``keyfilter.MAX_KEYS`` rows. The batch is read two or three times, so it
    should come from storage.
    """
    keys = [name for name in batch.columns if name not in ignore]
    known = target.select(*keys)
    if prune_on:
        low, high = batch.agg(F.min(prune_on), F.max(prune_on)).first()
        kind = batch.schema[prune_on].dataType
        known = known.filter(
            F.col(prune_on).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
        )
    wanted = batch.select(*keys)
    rows = wanted.count()
    if rows <= BROADCAST_ROWS and is_small(wanted):
        # No more distinct keys than the batch has rows: small enough to be sent, too.
        found = known.join(F.broadcast(wanted), keys, "left_semi").distinct()
        return batch.join(F.broadcast(found), keys, "left_anti")
    if rows <= MAX_KEYS:
        known = maybe_among(known, wanted, keys, keys=rows)
    return spread_join(batch, known.distinct(), keys, "left_anti")
