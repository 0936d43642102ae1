"""The similarity table of a set of vectors: for each, those nearest by cosine.

Equal vectors are one class. Classes are put into inverted lists, one for each
coarse centre, and every class looks for its neighbours in the lists of the centres
nearest to it; cosines there are exact. The lists, one after the other, are cut into
blocks of equal size, and so are the searchers. A task compares one block of either kind,
list by list, so a vector travels once for each block that it meets, however many lists
are searched there, and a list that holds a third of all classes is many tasks. Only the
best of each block travel on.

The centres come from a bounded sample; every vector is indexed and searched for. The
same sample tells how many lists must be searched for the recall that is wanted: vectors
that form clusters need few, vectors without any structure most of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill.operators.spread import spread_join
from placemill.runtime import cut_lineage

#: Vectors that the centres are fitted to, and rounds of the fit.
SAMPLE_VECTORS = 20_000
ROUNDS = 8
MAX_LISTS = 4096
#: Vectors of the sample whose neighbours tell how many lists to search.
TUNED_VECTORS = 500
#: Blocks of points and of searchers, and the most rows of a block: beyond, there are more.
BLOCKS = 8
BLOCK_ROWS = 1 << 17
#: Cosines that a task holds at once.
_AT_ONCE = 1 << 22

_MET = "a int, b int, point boolean, class binary, vector binary, lists binary"


def similarity_table(
    vectors: DataFrame,
    k: int = 5,
    *,
    lists: int | None = None,
    probes: int | None = None,
    recall: float = 0.95,
    id_column: str = "idx",
    vector_column: str = "embedding",
) -> DataFrame:
    """``(i, j, sim)``: for every vector the ``k`` others with the largest cosine.

    Ties go to the smaller ``j``; vectors that are equal have similarity 1. ``lists`` is the number of inverted
    lists, by default the square root of the number of different vectors; ``probes`` is how
    many of them are searched for a vector, by default as many as find the share ``recall`` of the
    neighbours that vectors of the sample have there. With
    ``probes`` equal to ``lists`` the result is exact. Null vectors, those with a null, and
    those without direction have no rows. Ids must be unique; vectors must have one length.
    """
    if k < 1:
        raise ValueError("need k of 1 or more")
    kind = vectors.schema[id_column].dataType.simpleString()
    members = cut_lineage(_members(vectors, id_column, vector_column, kind))
    classes = members.groupBy("class").agg(F.first("vector").alias("vector"))
    classes = cut_lineage(classes)
    count = classes.count()
    lists = min(lists or math.ceil(math.sqrt(count)), MAX_LISTS, max(count, 1))
    sample = _sample(classes, count)
    centres = _centres(sample, lists)
    probes = min(probes or _probes_for(sample, centres, k, recall), lists)
    near = _neighbours(classes, centres, probes, k, count)
    own = members.select("id", "class")

    # Of a class with many members only the k + 1 smallest ids can be among anybody's best.
    order = Window.partitionBy("class").orderBy("id")
    few = own.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    few = cut_lineage(few.drop("place"))
    found = near.join(few.withColumnRenamed("class", "other").withColumnRenamed("id", "j"), "other")
    found = found.unionByName(few.select("class", F.col("class").alias("other"), F.lit(1.0).alias("sim"), F.col("id").alias("j")))
    best = Window.partitionBy("class").orderBy(F.desc("sim"), "j")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    candidates = found.groupBy("class").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("down"), "j"))).alias("best")
    )  # at most k + 1
    others = F.slice(F.filter("best", lambda one: one["j"] != F.col("id")), 1, k)
    pairs = spread_join(own, candidates, ["class"], "inner").select(
        F.col("id").alias("i"), F.explode(others).alias("one")
    )
    return pairs.select("i", F.col("one.j").alias("j"), (-F.col("one.down")).alias("sim"))


def _members(vectors: DataFrame, id_column: str, vector_column: str, kind: str) -> DataFrame:
    """(id, class, vector): unit vectors as bytes; a class is a digest of the vector as given."""

    def run(batches):
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            rows = column.is_valid().to_numpy(zero_copy_only=False)
            keep, data = [], []
            for at, one in enumerate(column):
                if rows[at] and None not in (values := one.as_py()):
                    vector = np.array(values, np.float64)
                    length = np.linalg.norm(vector)
                    if length > 0 and np.isfinite(length):
                        keep.append(at)
                        data.append((vector / length).tobytes())
            yield pa.record_batch([ids.take(pa.array(keep, pa.int64())), pa.array(data, pa.binary())], ["id", "vector"])

    chosen = vectors.select(
        F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    unit = chosen.mapInArrow(run, f"id {kind}, vector binary")
    return unit.select("id", F.substring(F.unhex(F.sha2("vector", 256)), 1, 16).alias("class"), "vector")


def _sample(classes: DataFrame, count: int) -> np.ndarray:
    """About ``SAMPLE_VECTORS`` unit vectors, chosen by their digests."""
    share = min(1.0, SAMPLE_VECTORS / max(count, 1))
    parts = 1 << 20
    drawn = F.pmod(F.xxhash64("class"), F.lit(parts)) < max(1, round(share * parts))
    rows = classes.where(drawn).select("vector").toArrow().column(0).to_pylist()
    if not rows:
        return np.zeros((0, 1))
    sample = np.frombuffer(b"".join(sorted(rows))).reshape(len(rows), -1)
    return sample[np.random.default_rng(7).permutation(len(sample))]


def _centres(sample: np.ndarray, lists: int) -> np.ndarray:
    """Unit centres: the first vectors, then rounds of assignment and mean."""
    centres = sample[:lists].copy()
    for _ in range(ROUNDS if len(sample) else 0):
        parts = np.array_split(sample, len(sample) // 4096 + 1)
        nearest = np.concatenate([(part @ centres.T).argmax(axis=1) for part in parts])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-300), centres)
    return centres


def _probes_for(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """How many lists, nearest first, hold the share ``recall`` of the neighbours in the sample."""
    if len(sample) < 2:
        return 1
    searched = sample[-TUNED_VECTORS:]
    cosines = searched @ sample.T
    cosines[np.arange(len(searched)), len(sample) - len(searched) + np.arange(len(searched))] = -np.inf
    near = np.argsort(-cosines, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    parts = np.array_split(sample, len(sample) // 4096 + 1)
    home = np.concatenate([(part @ centres.T).argmax(axis=1) for part in parts])
    order = np.argsort(-(searched @ centres.T), axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
    needed = np.sort(np.take_along_axis(rank, home[near], axis=1).ravel()) + 1
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)])


def _nearest(batch: pa.RecordBatch, centres: np.ndarray, many: int):
    """Names of the classes, and the ``many`` nearest lists of each, its own first."""
    names, data = (column.to_pylist() for column in batch.columns)
    cosines = np.frombuffer(b"".join(data)).reshape(len(data), -1) @ centres.T
    return names, np.argsort(-cosines, axis=1, kind="stable")[:, :many]


def _shares(names: list[bytes]) -> np.ndarray:
    """A number of each class from its digest, evenly spread."""
    return np.frombuffer(b"".join(name[:8] for name in names), "<u8")


def _list_sizes(classes: DataFrame, centres: np.ndarray) -> np.ndarray:
    """How many classes are at home in each list; the driver sees a number a list."""

    def run(batches):
        for batch in batches:
            if len(batch):
                home, n = np.unique(_nearest(batch, centres, 1)[1], return_counts=True)
                yield pa.record_batch([pa.array(home, pa.int32()), pa.array(n)], ["list", "n"])

    counted = classes.select("class", "vector").mapInArrow(run, "list int, n long")
    sizes = np.zeros(len(centres), np.int64)
    for row in counted.groupBy("list").agg(F.sum("n").alias("n")).collect():
        sizes[row["list"]] = row["n"]
    return sizes


def _blocks(classes: DataFrame, centres: np.ndarray, probes: int, count: int) -> DataFrame:
    """Points, in the block of their place in the lists, met with every block of searchers;
    searchers, in a block of their own, met with the blocks of the lists that they search."""
    sizes = _list_sizes(classes, centres)
    blocks = max(BLOCKS, -(-count // BLOCK_ROWS))
    rows = max(1, -(-count // blocks))
    order = np.argsort(-(centres @ centres[0]), kind="stable") if len(centres) else sizes
    offsets = np.zeros(len(sizes), np.int64)
    offsets[order] = np.cumsum(sizes[order]) - sizes[order]
    first = np.minimum(offsets // rows, blocks - 1)
    last = np.minimum((offsets + np.maximum(sizes, 1) - 1) // rows, blocks - 1)
    # which lists are, in part at least, in which blocks
    holds = (first[:, None] <= np.arange(blocks)) & (np.arange(blocks) <= last[:, None])
    holds &= (sizes > 0)[:, None]

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                names, near = _nearest(part, centres, probes)
                share, home = _shares(names), near[:, 0]
                place = offsets[home] + (share % np.maximum(sizes[home], 1).astype("<u8")).astype(int)
                mine = np.minimum(place // rows, blocks - 1)
                own = (share >> np.uint64(32)) % np.uint64(blocks)
                out: list[tuple] = []
                for at in range(len(names)):
                    name = home[at : at + 1].astype(np.uint16).tobytes()
                    out += [(mine[at], other, True, at, name) for other in range(blocks)]
                    met = holds[near[at]]
                    for block in np.flatnonzero(met.any(axis=0)).tolist():
                        searched = near[at][met[:, block]].astype(np.uint16)
                        out.append((block, own[at], False, at, searched.tobytes()))
                a, b, point, at, lists = zip(*out, strict=True)
                rows_of = part.take(pa.array(at, pa.int64()))
                columns = [pa.array(np.array(a), pa.int32()), pa.array(np.array(b, int), pa.int32())]
                columns += [pa.array(point), *rows_of.columns, pa.array(lists, pa.binary())]
                yield pa.record_batch(columns, ["a", "b", "point", "class", "vector", "lists"])

    return classes.select("class", "vector").mapInArrow(run, _MET)


def _best_of(cosines: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the best ``k + 1`` of each row and of all that tie with the last
    place, so that the smaller ids can be told later."""
    width = min(k + 1, cosines.shape[1])
    top = np.argpartition(-cosines, width - 1, axis=1)[:, :width]
    least = np.take_along_axis(cosines, top, 1).min(axis=1)
    return np.nonzero((cosines >= least[:, None]) & np.isfinite(cosines))


def _neighbours(classes: DataFrame, centres: np.ndarray, probes: int, k: int, count: int) -> DataFrame:
    """(class, other, sim): the best ``k + 1`` other classes of each, over all its lists."""

    def best(table: pa.Table) -> pa.Table:
        point = table.column("point").to_numpy()
        names = np.array(table.column("class").to_pylist(), object)
        number = np.unique(names, return_inverse=True)[1]
        data = table.column("vector").to_pylist()
        matrix = np.frombuffer(b"".join(data)).reshape(len(data), -1)
        own = [np.frombuffer(one, np.uint16) for one in table.column("lists").to_pylist()]
        size = np.array([len(one) for one in own], int)
        row, lists = np.repeat(np.arange(len(own)), size), np.concatenate(own)
        order = np.argsort(lists, kind="stable")
        row, lists = row[order], lists[order]
        cuts = np.flatnonzero(lists[1:] != lists[:-1]) + 1
        found: list[tuple] = []
        kept = [np.zeros(0, int), np.zeros(0, int), np.zeros(0)]
        waiting = 0
        for rows in np.split(row, cuts):
            here, there = rows[point[rows]], rows[~point[rows]]
            if not len(here) or not len(there):
                continue
            here = here[np.argsort(number[here], kind="stable")]
            for some in np.array_split(there, len(there) * len(here) // _AT_ONCE + 1):
                if not len(some):
                    continue
                cosines = matrix[some] @ matrix[here].T
                cosines[number[some][:, None] == number[here][None, :]] = -np.inf
                left, right = _best_of(cosines, k)
                found.append((some[left], here[right], cosines[left, right]))
                waiting += len(left)
            if waiting > _AT_ONCE:
                kept, found, waiting = _merged([kept, *found], k), [], 0
        a, b, sim = _merged([kept, *found], k)
        return pa.table(
            {
                "class": pa.array(names[a].tolist(), pa.binary()),
                "other": pa.array(names[b].tolist(), pa.binary()),
                "sim": pa.array(np.clip(sim, -1.0, 1.0)),
            }
        )

    met = _blocks(classes, centres, probes, count)
    scored = met.groupBy("a", "b").applyInArrow(best, "class binary, other binary, sim double")
    rank = F.rank().over(Window.partitionBy("class").orderBy(F.desc("sim")))
    return scored.withColumn("place", rank).where(F.col("place") <= k + 1).drop("place")


def _merged(found: list, k: int) -> list[np.ndarray]:
    """Of (searcher, point, cosine), those with fewer than ``k + 1`` better ones."""
    a, b, sim = (np.concatenate(side) for side in zip(*found, strict=True))
    order = np.lexsort((b, -sim, a))
    a, b, sim = a[order], b[order], sim[order]
    if len(a):
        start = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        n = np.diff(start, append=len(a))
        limit = sim[start + np.minimum(k, n - 1)]
        keep = sim >= np.repeat(limit, n)
        a, b, sim = a[keep], b[keep], sim[keep]
    return [a, b, sim]
