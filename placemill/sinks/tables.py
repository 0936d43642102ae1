"""Loads into tables with declared schemas."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class TableSet(dict):
    """Named output tables together with the intermediate results they share.

    A pipeline returns one. ``write_all`` keeps the shared parents while it
    writes, so several tables do not scan and clean the same input again.
    """

    def __init__(self, tables: Mapping[str, DataFrame], shared: Iterable[DataFrame] = ()):
        super().__init__(tables)
        self.shared = list(shared)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types. Extra ones go."""
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target table: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def append_table(
    df: DataFrame, table: str, schema: StructType, *, fmt: str = "parquet", path: str | None = None
) -> None:
    """Create ``table`` with ``schema`` if it is missing, then load ``df``.

    An existing table is appended to, a new one starts with this load. A rerun
    appends the same rows again; filter with ``only_new`` to avoid that.
    """
    mode = "append" if df.sparkSession.catalog.tableExists(table) else "overwrite"
    writer = conform(df, schema).write.format(fmt).mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def save(
    df: DataFrame, target: str, *, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> None:
    """Append through any Spark connector; the target is created if needed."""
    df.write.format(fmt).options(**(options or {})).mode("append").save(target)


def write_all(tables: Mapping[str, DataFrame], sink: Callable[[str, DataFrame], None]) -> None:
    """Hand every table to ``sink(name, df)``, computing shared parents once."""
    shared = getattr(tables, "shared", ()) if len(tables) > 1 else ()
    kept = [parent.persist(StorageLevel.MEMORY_AND_DISK) for parent in shared]
    try:
        for name, df in tables.items():
            sink(name, df)
    finally:
        for parent in kept:
            parent.unpersist()
