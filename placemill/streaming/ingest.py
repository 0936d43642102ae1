"""File-arrival ingestion with Structured Streaming.

Each arriving file is read once, put through a table builder and appended to
the builder's output tables. The streaming checkpoint records which files went
into which batch, and ``BatchFolders`` replaces the output of a batch that is
run again, so a restart neither loses nor doubles rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from placemill.operators.incremental import only_new
from placemill.runtime import cut_lineage
from placemill.sinks.tables import conform, write_all
from placemill.sources.readers import POSITION

Build = Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: JSON in which different values stay different.
_EXACT = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class BatchFolders:
    """Parquet tables below ``root``, one folder per table and batch.

    A batch always writes the same folder, in overwrite mode. ``schemas`` gives
    the declared columns per table. Tables named in ``new_only`` map to the
    columns to leave out of the comparison; of their rows only those are written
    that equal no row of an earlier batch. ``prune_on`` names, per table, a column
    whose range in the batch limits the earlier rows that are read for that.
    """

    root: str
    schemas: Mapping[str, StructType]
    new_only: Mapping[str, Sequence[str]] = field(default_factory=dict)
    prune_on: Mapping[str, str] = field(default_factory=dict)

    def write(self, name: str, df: DataFrame, batch_id: int) -> None:
        df = conform(df, self.schemas[name])
        if name in self.new_only:
            earlier = self._stored(df.sparkSession, name).filter(F.col("batch_id") < batch_id)
            df = only_new(
                df,
                earlier.drop("batch_id"),
                ignore=self.new_only[name],
                prune_on=self.prune_on.get(name),
            )
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return self._stored(spark, name).drop("batch_id")

    def _stored(self, spark: SparkSession, name: str) -> DataFrame:
        columns = StructType([*self.schemas[name].fields, StructField("batch_id", LongType())])
        folder = f"{self.root}/{name}"
        if not _exists(spark, folder):
            return spark.createDataFrame([], columns)
        return spark.read.schema(columns).parquet(folder)


def ingest(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    build: Build,
    sink: BatchFolders,
    *,
    glob: str,
    checkpoint: str,
    name: str = "data",
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
    static: Callable[[SparkSession], Mapping[str, DataFrame]] | None = None,
    max_files: int | None = None,
    known_by: Sequence[str] | None = None,
) -> StreamingQuery:
    """Start a query that takes in all files not seen yet, then stops.

    ``build`` gets the new rows as input ``name``, with the position columns of
    ``read_many``, next to the inputs of ``static``, which is called for every
    batch so that changed side tables are seen. ``max_files`` bounds a batch.

    ``known_by`` names columns: rows that agree in all of them (nulls alike) are taken
    once, however often and in whichever batch they arrive; which one of those that arrive
    together is not fixed. A digest of a row's columns is kept in the state store, so a batch costs
    as much as its own rows, whatever was loaded before. Rows pass through a shuffle on the
    digest and lose their order within a file.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("mode", "FAILFAST")
    reader = reader.options(**(options or {}))
    reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(folder).select(
        "*",
        F.col("_metadata.file_path").alias(POSITION[0]),
        F.col("_metadata.file_block_start").alias(POSITION[1]),
    )
    if known_by is not None:
        rows = first_arrivals(rows, known_by)

    def load(batch: DataFrame, batch_id: int) -> None:
        sides = static(batch.sparkSession) if static else {}
        if known_by is not None:
            # Several tables read the batch; all must see the same choice among equal rows.
            batch = cut_lineage(batch)
        placed = batch.withColumn(POSITION[2], F.monotonically_increasing_id())
        tables = build({**sides, name: placed})
        write_all(tables, lambda table, df: sink.write(table, df, batch_id))

    writer = rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    with state_on_disk(spark):
        return writer.trigger(availableNow=True).start()


def first_arrivals(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of a stream whose values in ``columns`` have not been met before."""
    name = "_digest"
    while name in rows.columns:
        name = "_" + name
    values = F.to_json(F.struct(*columns), _EXACT)
    digested = rows.withColumn(name, F.unhex(F.sha2(values, 256)))
    return digested.dropDuplicates([name]).drop(name)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, not on the heap.

    A session that names a state store itself keeps it, and so does a query that is
    started again from its checkpoint.
    """
    own = spark.conf.get(_STATE_STORE, None)
    if own is None or own.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_STATE_STORE)
        else:
            spark.conf.set(_STATE_STORE, own)


@dataclass(frozen=True)
class Route:
    """Files whose name matches ``glob`` and the builder that takes them."""

    glob: str
    schema: StructType
    build: Build
    name: str
    fmt: str = "json"


def ingest_routes(
    spark: SparkSession,
    folder: str,
    routes: Sequence[Route],
    sink: BatchFolders,
    *,
    checkpoint: str,
) -> list[StreamingQuery]:
    """One query per route over the same folder, each with its own checkpoint."""
    return [
        ingest(
            spark,
            folder,
            route.schema,
            route.build,
            sink,
            glob=route.glob,
            checkpoint=f"{checkpoint}/{at}",
            name=route.name,
            fmt=route.fmt,
        )
        for at, route in enumerate(routes)
    ]


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
