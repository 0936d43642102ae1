"""Files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, folder: str, suffix: str | None = None) -> DataFrame:
    """``path, length, modificationTime`` of the files below ``folder``.

    Only the listing is read: the content column is pruned.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(folder).select("path", "length", "modificationTime")


def parent_globs(files: DataFrame, suffix: str = ".csv") -> DataFrame:
    """The distinct folders that hold files ending in ``suffix``, as globs."""
    parent = F.regexp_replace("path", "/[^/]*$", f"/*{suffix}")
    return files.filter(F.col("path").endswith(suffix)).select(parent.alias("glob")).distinct()
