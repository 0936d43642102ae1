"""Packing of documents into sequences by cutting-stock column generation.

1. Every document becomes ids and an end id. Full sequences are cut off its front; what
   is left, shorter than a sequence, is one item. Nothing else is cut.
2. The items' lengths, rounded up to ``unit`` tokens, give a histogram of at most
   ``capacity / unit`` classes, the only thing the driver sees. A linear program over
   patterns (how many items of each class fill a sequence) is solved by column
   generation: a knapsack over the dual prices finds the next pattern. Patterns are
   rounded down; the few items left over are placed largest first, each with the items
   that fill its sequence best.
3. Patterns are runs of slots for each class. Items are ranked within their class,
   bucket by bucket, and the rank is the slot, so a class that holds a third of all
   documents is ranked in many tasks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placemill.llm import words as W
from placemill.llm.shared import free_worker, give_back, shuffle_partitions, stored
from placemill.llm.tokens import encoder
from placemill.runtime import broadcast_if_small

CAPACITY = 2048
#: Column generation ends this near, as a share, to the least number of sequences.
GAP = 4e-4

_GREEDY_ITEMS = 3000

Pattern = dict[int, int]


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of items within ``capacity``, and its counts."""
    order = np.argsort(sizes, kind="stable")
    useful = order[prices[order] > 1e-12]
    size, price = sizes[useful], prices[useful]
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = np.searchsorted(size, room, side="right")
        if fits:
            value = best[room - size[:fits]] + price[:fits]
            top = int(value.argmax())
            if value[top] > best[room] + 1e-12:
                best[room], taken[room] = value[top], top
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
            continue
        counts[useful[taken[room]]] += 1
        room -= int(size[taken[room]])
    return float(best[capacity]), counts


def fullest(sizes: list[int], left: list[int], room: int) -> list[int]:
    """Indexes of items (``left`` of each size, largest first) that fill ``room`` best."""
    reached = np.zeros(room + 1, bool)
    reached[0] = True
    last = np.full(room + 1, -1)
    for at, size in enumerate(sizes):
        for _ in range(min(left[at], room // size) if not reached[room] else 0):
            new = reached[: room + 1 - size] & ~reached[size:]
            if not new.any():
                break
            where = np.flatnonzero(new) + size
            reached[where], last[where] = True, at
    total, chosen = int(np.flatnonzero(reached)[-1]), []
    while total:
        chosen.append(int(last[total]))
        total -= sizes[chosen[-1]]
    return chosen


def best_fit(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Sequence by sequence: the largest item left and the items that fill it up best."""
    order = np.argsort(-sizes, kind="stable")
    size, left = sizes[order].tolist(), counts[order].astype(int).tolist()
    patterns = []
    for at in range(len(size)):
        while left[at]:
            left[at] -= 1
            chosen = [at, *fullest(size, left, capacity - size[at])]
            pattern: Pattern = {}
            for one in chosen:
                pattern[size[one]] = pattern.get(size[one], 0) + 1
            for one in chosen[1:]:
                left[one] -= 1
            patterns.append(pattern)
    return patterns


def column_generation(
    sizes: np.ndarray, demand: np.ndarray, capacity: int
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one column each) and how often each is used, in fractions.

    Revised simplex for: as few sequences as can be, every class used exactly as often as
    it occurs. It begins with sequences of one class each and with the patterns of a
    greedy packing of a small copy of the demand as candidates; known candidates are
    priced first, then the knapsack finds new ones. It ends near the bound that the sum
    of sizes gives, or when no pattern is worth more than a sequence. The demand is
    shifted a little so that no two classes run out at once.
    """
    count = len(sizes)
    exact, demand = demand, demand + np.random.default_rng(7).random(count) * 1e-3
    small = np.ceil(demand * min(1.0, _GREEDY_ITEMS / demand.sum()))
    known = {
        tuple(pattern.get(size, 0) for size in sizes.tolist())
        for pattern in best_fit(sizes, small, capacity)
    }
    pool = np.array(sorted(known), float).T
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    used = inverse @ demand
    bound = sizes @ demand / capacity
    fresh: list[np.ndarray] = []
    for step in range(1, 20 * count + 1):
        if used.sum() <= bound + max(GAP * bound, 0.1):
            break
        prices = inverse.sum(axis=0)
        worth = prices @ pool
        pattern = pool[:, int(worth.argmax())]
        if worth.max() <= 1 + 1e-6:
            value, pattern = knapsack(sizes, prices, capacity)
            if value <= 1 + max(GAP, 0.1 / used.sum()):
                break
            fresh.append(pattern)
            if len(fresh) % 64 == 0:
                pool = np.column_stack([pool, *fresh[-64:]])
        change = inverse @ pattern
        ratio = np.full(count, np.inf)
        can = change > 1e-9
        ratio[can] = np.maximum(used[can], 0) / change[can]
        out = int(ratio.argmin())
        basis[:, out] = pattern
        pivot = inverse[out] / change[out]
        used = used - change * ratio[out]
        used[out] = ratio[out]
        inverse = inverse - np.outer(change, pivot)
        inverse[out] = pivot
        if step % 256 == 0:
            inverse = np.linalg.inv(basis)
            used = inverse @ demand
    return basis, np.maximum(np.linalg.solve(basis, exact), 0)


def cutting_plan(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns {size: items} and how many sequences follow each; places every item."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[size] for size in sizes.tolist()], float)
    basis, used = column_generation(sizes, demand, capacity)
    left, plan = demand.copy(), []
    for at in np.argsort(-used, kind="stable"):
        pattern = np.rint(basis[:, at])
        has = pattern > 0
        times = int(min(np.floor(used[at] + 1e-6), np.floor((left[has] / pattern[has]).min())))
        if times > 0:
            left -= times * pattern
            filled = zip(sizes[has].tolist(), pattern[has].astype(int).tolist(), strict=True)
            plan.append((dict(filled), times))
    return plan + [(pattern, 1) for pattern in best_fit(sizes, left, capacity)]


def slots(plan: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(class, first rank, end rank, items in a sequence, first sequence, order) rows."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in plan:
        for order, (size, count) in enumerate(sorted(pattern.items(), reverse=True)):
            begin = taken.get(size, 0)
            taken[size] = begin + count * times
            rows.append((size, begin, taken[size], count, sequence, order))
        sequence += times
    return rows


def cut_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keep_ids: bool
) -> DataFrame:
    """Full sequences and the rest of every row of ``docs`` (id, text), one row a piece."""

    def run(batches):
        free_worker(keep=(tokenizer,))
        encode = encoder(tokenizer)
        for batch in batches:
            for begin, end in W.pieces(batch.column(1)):
                part = batch.slice(begin, end - begin)
                rows: list[tuple] = []
                last = np.array([end_id], "<u4")
                for key, own in zip(
                    part.column(0).to_pylist(), encode(part.column(1)), strict=True
                ):
                    ids = np.concatenate([own, last])
                    for start in range(0, len(ids), capacity):
                        piece = ids[start : start + capacity]
                        rows.append((key, start, piece, len(ids)))
                columns = [
                    pa.array([row[0] for row in rows], part.column(0).type),
                    pa.array([row[1] for row in rows], pa.int64()),
                    pa.array([len(row[2]) for row in rows], pa.int64()),
                    pa.array([zlib.crc32(row[2].tobytes()) for row in rows], pa.int64()),
                    pa.array([row[3] for row in rows], pa.int64()),
                ]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    ids = [row[2].astype(np.int32) for row in rows]
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(columns, names)
            give_back()

    schema = f"id {docs.schema['id'].dataType.simpleString()}, start long, length long, "
    schema += "ids_crc32 long, doc_tokens long" + (", ids array<int>" if keep_ids else "")
    return docs.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = 1,
    unit: int = 4,
    keep_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each piece of a document, with its place in a sequence.

    Columns: the id, ``start`` (ids of the document before the piece), ``length``,
    ``ids_crc32`` (of the ids as little-endian 32-bit numbers), ``doc_tokens`` (with the
    end id), ``sequence_id``, ``offset`` (in the sequence, without gaps from 0), and with
    ``keep_ids`` the ``ids``. No sequence holds more than ``capacity`` ids. Padding comes
    from rounding to ``unit`` and from the last few sequences.

    Null text is empty: a document of the end id alone. Null and repeated ids are packed
    row by row. An empty table gives no rows. Same input, same sequences.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    pieces = stored(cut_pieces(source, tokenizer, end_id, capacity, keep_ids), "pieces")
    kind = F.ceil(F.col("length") / unit).cast("int")
    buckets = 4 * shuffle_partitions(spark)
    bucket = F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(buckets)).cast("int")
    items = pieces.select("*", kind.alias("kind"), bucket.alias("bucket"))

    counts = stored(items.groupBy("kind", "bucket").agg(F.count(F.lit(1)).alias("n")), "counts")
    found = counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()
    histogram = {row["kind"]: row["n"] for row in found}
    rows = slots(cutting_plan(histogram, capacity // unit))
    names = "kind int, begin long, end long, per long, sequence long, turn int"
    table = F.broadcast(spark.createDataFrame(rows, names))

    before = Window.partitionBy("kind").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "kind", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("kind", "bucket").orderBy("id", "start", "ids_crc32")
    ranked = items.withColumn("place", F.row_number().over(within) - 1)
    ranked = ranked.join(broadcast_if_small(offsets), ["kind", "bucket"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("place"))
    placed = ranked.join(table, "kind").where("rank >= begin and rank < end")
    placed = placed.withColumn(
        "sequence_id", F.expr("sequence + (rank - begin) div per")
    ).withColumn("turn_rank", F.expr("(rank - begin) % per"))
    ahead = (
        Window.partitionBy("sequence_id")
        .orderBy("turn", "turn_rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(ahead), F.lit(0))
    return placed.select(
        F.col("id").alias(id_column),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        offset.alias("offset"),
        *(["ids"] if keep_ids else []),
    )
