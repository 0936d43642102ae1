"""One stream over the names of arriving files, which deals each file to a route."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from placemill.sinks.tables import TableSet, write_all
from placemill.sources.readers import with_position
from placemill.streaming.ingest import BatchFolders, Route

#: Files of one batch; their names go through the driver.
MAX_FILES = 1000

_FILES = "path string, modificationTime timestamp, length long, content binary"

Sides = Callable[[SparkSession], Mapping[str, DataFrame]]


def matches(glob: str, path: str) -> bool:
    """Whether a path below the folder matches; a glob without ``/`` looks at the name only."""
    return fnmatchcase(path if "/" in glob else path.rsplit("/", 1)[-1], glob)


def deal(
    paths: Iterable[str], routes: Sequence[Route], default: Route | None = None
) -> dict[Route, list[str]]:
    """Each path under the first route that matches, else under ``default``."""
    dealt: dict[Route, list[str]] = {}
    for path in sorted(paths):
        route = next((route for route in routes if matches(route.glob, path)), default)
        if route is None:
            raise ValueError(f"no route for the file {path}")
        dealt.setdefault(route, []).append(path)
    return dealt


def ingest_by_name(
    spark: SparkSession,
    folder: str,
    routes: Sequence[Route],
    sink: BatchFolders,
    *,
    checkpoint: str,
    default: Route | None = None,
    static: Sides | None = None,
    max_files: int = MAX_FILES,
) -> StreamingQuery:
    """Start one query that loads every file below ``folder`` exactly once, then stops.

    A file goes to the first of ``routes`` whose glob matches, and to ``default`` if none
    does, whatever that route's glob. Without a default a file that matches nothing fails its
    batch, so that none is passed over in silence. Names that begin with ``_`` or ``.`` are not
    seen, as everywhere in Spark.

    The stream carries paths only, at most ``max_files`` a batch; the checkpoint records
    which files are in which batch. The files of a route are read by one scan, and its
    builder gets the rows under ``route.name`` with the position columns, next to the
    inputs of ``static``. Rows that several routes give one table are put together. A batch
    that is run again replaces its own folders.
    """
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    reader = reader.options(recursiveFileLookup=True, maxFilesPerTrigger=max_files)
    # The contents are not read: only the path is selected.
    paths = reader.load(folder).select("path")

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        arrived = {_below(folder, row["path"]): row["path"] for row in batch.collect()}
        sides = static(session) if static else {}
        parts: dict[str, list[DataFrame]] = {}
        shared: list[DataFrame] = []
        for route, names in deal(arrived, routes, default).items():
            reader = session.read.schema(route.schema).option("mode", "FAILFAST")
            rows = reader.format(route.fmt).load([_literal(arrived[name]) for name in names])
            tables = route.build({**sides, route.name: with_position(rows)})
            shared += getattr(tables, "shared", ())
            for table, df in tables.items():
                parts.setdefault(table, []).append(df)
        whole = {
            table: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
            for table, found in parts.items()
        }
        write_all(TableSet(whole, shared), lambda table, df: sink.write(table, df, batch_id))

    writer = paths.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _below(folder: str, path: str) -> str:
    """The part of a file's path below the folder."""
    inside, root = (re.sub(r"^[a-z0-9+.-]+:(//[^/]*)?(?=/)", "", p) for p in (path, folder))
    root = root.rstrip("/") + "/"
    return inside.removeprefix(root)


def _literal(path: str) -> str:
    """A path whose characters are no pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)
