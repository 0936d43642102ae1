"""Helpers of the operators: tables in the shared folder, partitions, checks."""

from __future__ import annotations

import ctypes
import gc
import sys
import types

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.runtime import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    Cuts the lineage like a checkpoint: a lost executor loses no part of it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Ids, 8 bytes each, that are sent to all tasks; more are joined by shuffle.
BROADCAST_IDS = 1_000_000


def id_filter(ids: DataFrame, name: str) -> DataFrame:
    """The distinct ids of a one-column table, to be broadcast if their count allows it."""
    ids = stored(ids.distinct(), name)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def worker_memory() -> dict:
    """A dictionary that lives as long as the Python process; tasks of a worker share it."""
    return sys.modules.setdefault("_placemill_memory", types.SimpleNamespace(kept={})).kept


def free_worker(*, keep: tuple[str, ...] = ()) -> None:
    """Give back what tasks of earlier operators left in this Python process.

    Workers are used again from job to job. Without this, the tokenizer and the words that
    packing remembers stay beside whatever the next operator needs. ``keep`` names what
    stays in :func:`worker_memory`.
    """
    memory = worker_memory()
    for name in set(memory) - set(keep):
        del memory[name]
    give_back()


def give_back() -> None:
    """Return pages without live data to the system; nothing that is still used is lost.

    Many small and large blocks in turn leave a heap of several times its live data, and
    a worker that waits for its next task would keep it.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # GNU C library only
        trim(0)


def free_worker_once() -> None:
    """:func:`free_worker`, at the first call of a task only."""
    context = TaskContext.get()
    task = context.taskAttemptId() if context else None
    if task is None or worker_memory().get("freed") != task:
        free_worker()
        worker_memory()["freed"] = task


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(id_column: str, buckets: int) -> Column:
    """A bucket for each id, the same for equal ids; null is in a bucket, too."""
    return F.pmod(F.xxhash64(F.col(id_column)), F.lit(buckets)).cast("int")


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores in front until ``df`` has no such column."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish
