"""Frequencies and table profiles, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(col, count)`` without nulls, most frequent first, ties by value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), col)


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls of every column."""
    return df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in df.columns])


def profile(df: DataFrame) -> DataFrame:
    """``(column, dtype, non_null, nulls, row_count)``, one row per column."""
    totals = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(F.col(f"`{name}`")).alias(f"_{at}") for at, name in enumerate(df.columns)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).alias("dtype"),
                F.col(f"_{at}").alias("non_null"),
                (F.col("_rows") - F.col(f"_{at}")).alias("nulls"),
                F.col("_rows").alias("row_count"),
            )
            for at, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return totals.select(F.inline(lines))
