"""Session helpers: shared working folders and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    go without: it gets a temporary folder of its own. On a cluster a folder
    of one machine would not be seen by the others, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="placemill-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the copy."""
    folder = shared_dir(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def broadcast_if_small(
    df: DataFrame, *, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``df`` with a broadcast hint if its measured size is within the bounds.

    The check takes the widths of at most ``max_rows + 1`` rows, one number each.
    A larger side comes back unhinted and is joined by shuffle, where adaptive
    execution splits skewed partitions.
    """
    return F.broadcast(df) if is_small(df, max_rows=max_rows, max_bytes=max_bytes) else df


def is_small(
    df: DataFrame, *, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` is measured to be within the bounds of a broadcast."""
    width = F.length(F.to_json(F.struct(*df.columns)))
    widths = df.select(width).take(max_rows + 1)
    return len(widths) <= max_rows and sum(row[0] or 0 for row in widths) <= max_bytes
