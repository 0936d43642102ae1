"""Nested columns to rows and columns, and null filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_option(
    df: DataFrame, key: str, col, out: str, *, outer: bool = False
) -> DataFrame:
    """One row ``(key, out)`` per array item.

    Null and empty arrays give no row, or one null row with ``outer=True``.
    """
    items = F.col(col) if isinstance(col, str) else col
    return df.select(key, (F.explode_outer if outer else F.explode)(items).alias(out))


def map_columns(
    df: DataFrame, map_col: str, keys: Sequence[str], fill: str | None = None
) -> DataFrame:
    """Replace a map by one column per listed key; absent keys are ``fill``."""
    picked = {key: F.try_element_at(F.col(map_col), F.lit(key)) for key in keys}
    if fill is not None:
        picked = {key: F.coalesce(value, F.lit(fill)) for key, value in picked.items()}
    rest = [name for name in df.columns if name != map_col]
    return df.select(*rest, *[value.alias(key) for key, value in picked.items()])


def map_keys(df: DataFrame, map_col: str) -> DataFrame:
    """``(key, n)``: the keys of a map column and how many rows have each."""
    return df.select(F.explode(F.map_keys(map_col)).alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("n")
    )


def open_map_columns(
    df: DataFrame,
    map_col: str,
    *,
    most: int = 1000,
    least_rows: int = 1,
    rest: str | None = None,
    fill: str | None = None,
) -> DataFrame:
    """Replace a map by a column for each key found in it, commonest first, then by name.

    Keys are counted in one pass, map side first, and at most ``most + 1`` reach the driver. Only keys of
    ``least_rows`` rows or more become columns. If others remain, or there are more than
    ``most``, they stay together in a map column named ``rest``; without that name it is an
    error to have more than ``most``. Keys that a column name cannot tell apart (letter case,
    or a column of ``df``) count as remaining.
    """
    if most < 1:
        raise ValueError("need most of 1 or more")
    counted = map_keys(df, map_col).where(F.col("n") >= least_rows)
    found = [row["key"] for row in counted.orderBy(F.desc("n"), "key").limit(most + 1).collect()]
    if len(found) > most and rest is None:
        raise ValueError(f"more than {most} keys in {map_col}: name a column for the rest")
    taken = {name.lower() for name in (*df.columns, rest or "") if name != map_col}
    keys = []
    for key in found[:most]:
        if key.lower() not in taken:
            taken.add(key.lower())
            keys.append(key)
    if rest is None:
        if len(keys) < len(found):
            raise ValueError(f"keys of {map_col} that no column name tells apart")
        return map_columns(df, map_col, keys, fill)
    known = F.array(*[F.lit(key) for key in keys]).cast("array<string>")
    left = F.map_filter(map_col, lambda key, _: ~F.array_contains(known, key))
    return map_columns(df.withColumn(rest, left), map_col, keys, fill)


def fill_nulls(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Fill nulls per column; a column that is not there is an error."""
    return df.fillna(values)
