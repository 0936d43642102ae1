"""Column-level operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_strict(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; unlike ``drop``, a name that is not there is an error."""
    absent = [name for name in cols if name not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    return df.drop(*cols)


def dedupe_column_names(df: DataFrame) -> DataFrame:
    """Keep the first column of every name."""
    names = df.columns
    by_place = df.toDF(*[f"_{place}" for place in range(len(names))])
    first = {name: names.index(name) for name in names}
    return by_place.select(*[F.col(f"_{place}").alias(name) for name, place in first.items()])
