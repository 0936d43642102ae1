"""Loads that are committed by name: each counts once, in whole or not at all.

A load writes its rows into a folder of its own and then names that folder in the
table's load log. Rows count from that moment. A load that fails before leaves nothing
that a reader sees, one that is run again adds nothing, and loads that begin at the
same time, the first ones included, do not know of each other.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from placemill.sinks.tables import conform

_LOG, _DATA = "_loads", "data"


def load_once(df: DataFrame, root: str, schema: StructType, load_id: str) -> bool:
    """Load ``df`` into the table at ``root`` as ``load_id``; whether this call did it.

    The id is letters, digits, ``.``, ``_`` and ``-``. If two runs of one load overlap, the
    rows of one of them count.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", load_id):
        raise ValueError(f"not a load id: {load_id!r}")
    spark = df.sparkSession
    if _entry(spark, root, load_id):
        return False
    folder = f"{load_id}-{uuid.uuid4().hex}"
    conform(df, schema).write.parquet(f"{root}/{_DATA}/{folder}")
    return _commit(spark, root, load_id, folder)


def committed_loads(spark: SparkSession, root: str) -> dict[str, str]:
    """Load ids and the folders that hold their rows."""
    files, log = _files(spark, f"{root}/{_LOG}")
    if not files.exists(log):
        return {}
    names = [status.getPath().getName() for status in files.listStatus(log)]
    found = {name: _entry(spark, root, name) for name in sorted(names)}
    return {name: folder for name, folder in found.items() if folder}


def read_loads(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The rows of all committed loads."""
    folders = committed_loads(spark, root).values()
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{_DATA}/{folder}" for folder in folders])


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _entry(spark: SparkSession, root: str, load_id: str) -> str | None:
    """The folder that the log names for a load; an entry that was cut short names none."""
    files, place = _files(spark, f"{root}/{_LOG}/{load_id}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return text[:-1] if text.endswith("\n") else None


def _commit(spark: SparkSession, root: str, load_id: str, folder: str) -> bool:
    files, place = _files(spark, f"{root}/{_LOG}/{load_id}")
    try:
        # Only one of several runs can create the entry.
        stream = files.create(place, False)
    except Exception:
        if _entry(spark, root, load_id):
            return False
        stream = files.create(place, True)  # left behind by a run that ended here
    stream.write(bytearray(f"{folder}\n".encode()))
    stream.close()
    return _entry(spark, root, load_id) == folder
