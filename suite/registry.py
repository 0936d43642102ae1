"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The test tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key``, with its check if SQL has one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate key: {key}")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLE[key] = sql
        return fn

    return register
