"""Positions of rows in a total order, without a one-task window.

To number all rows, they are range-partitioned and sorted, then numbered as partition
offset plus place in the partition. The sorted rows are checkpointed, so the offsets
and the numbering see the same partitions even if executors are lost.

Cutting rows into ranges needs a few boundary keys only, and these are selected without
a sort: a bounded sample proposes cuts around each wanted place, one grouped count says
between which cuts it lies, and the search goes on there until few enough keys are left to be
sorted. The full rows are compared with the boundaries as they are scanned, and the
comparison of the first column reaches the scan.

``order_by`` must name columns that together are unique; nulls come first. The
input is read more than once, so it should come from storage.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from placemill.runtime import cut_lineage

_SEQ_BITS = 33  # monotonically_increasing_id: partition number above, place below
#: Keys that are sorted to find exact places, once no more than these are left.
SORT_KEYS = 20_000
#: Keys of a sample, and cuts that a count distinguishes.
SAMPLE_KEYS = 20_000
CUTS = 256
_EXACT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_WINDOWS = 16  # ranges that are named one by one in a scan's filter


def with_row_index(df: DataFrame, order_by: Sequence[str], out: str = "idx") -> DataFrame:
    """Add the dense position 0, 1, 2, ... of every row under ``order_by``."""
    numbered = cut_lineage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftright("_id", _SEQ_BITS).alias("_part")
    sizes = numbered.groupBy(part).agg(F.count("*").alias("_size"))
    # One row per partition: the window below sees no more rows than that.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    place = F.col("_id").bitwiseAND((1 << _SEQ_BITS) - 1)
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + place)
        .drop("_id", "_part", "_start")
    )


def row_range(df: DataFrame, order_by: Sequence[str], start: int, stop: int) -> DataFrame:
    """The rows at positions ``start`` (included) to ``stop`` (excluded)."""
    if not 0 <= start <= stop:
        raise ValueError("need 0 <= start <= stop")
    if start == stop:
        return df.filter(F.lit(False))
    keys = _keys_at(df, order_by, [start, stop])
    return _between(df, order_by, start, stop, keys)


def row_pages(df: DataFrame, order_by: Sequence[str], size: int) -> Iterator[DataFrame]:
    """The rows in pages of ``size``, in order; all boundaries come from one selection."""
    if size < 1:
        raise ValueError("need a size of 1 or more")
    rows = df.count()
    starts = list(range(0, rows, size))
    keys = _keys_at(df, order_by, starts[1:], rows)
    for start in starts:
        yield _between(df, order_by, start, start + size, keys)


def _between(df, order_by, start: int, stop: int, keys: dict) -> DataFrame:
    if start > 0:
        df = df.filter(_from_key(df, order_by, keys[start])) if start in keys else df.limit(0)
    if stop in keys:
        df = df.filter(_before_key(df, order_by, keys[stop]))
    return df


def split_contiguous(
    df: DataFrame, n: int, order_by: Sequence[str], *, mode: str = "floor", out: str = "part"
) -> DataFrame:
    """Add the number 0 .. n-1 of the contiguous part every row belongs to.

    ``floor``: parts of ``rows // n``, the last takes the remainder (all rows if
    there are fewer than ``n``). ``ceil``: parts of ``ceil(rows / n)``, the last
    ones may be short or empty.
    """
    if n < 1 or mode not in ("floor", "ceil"):
        raise ValueError("need n >= 1 and mode 'floor' or 'ceil'")
    rows = df.count()
    size = rows // n if mode == "floor" else -(-rows // n)
    if size == 0:
        return df.withColumn(out, F.lit(n - 1))
    starts = [part * size for part in range(1, n) if part * size < rows]
    keys = _keys_at(df, order_by, starts, rows)
    cuts = [keys[start] for start in starts]
    return df.withColumn(out, _reached(df, order_by, cuts))


@dataclass(frozen=True)
class _Range:
    """Rows between two keys, both left out (None: no bound), of which places are wanted."""

    low: tuple | None
    high: tuple | None
    before: int
    rows: int
    wanted: tuple[int, ...]


def keys_at_places(
    df: DataFrame, order_by: Sequence[str], places: Sequence[int], rows: int | None = None
) -> dict[int, tuple]:
    """The key at each listed place (from 0) that exists. Reads key columns only.

    Each round reads the ranges that are left twice: for a sample of about
    ``SAMPLE_KEYS`` keys, and to count the rows between cuts. Ranges shrink to a small
    part each time, so rounds grow with the logarithm of the rows. A key that many rows
    share is found as a cut itself, and ends the search of its places.
    """
    keys = df.select(*order_by)
    rows = keys.count() if rows is None else rows
    wanted = tuple(sorted({place for place in places if 0 <= place < rows}))
    found: dict[int, tuple] = {}
    ranges = [_Range(None, None, 0, rows, wanted)] if wanted else []
    seed = 0
    while sum(one.rows for one in ranges) > SORT_KEYS:
        seed += 1
        left = sum(one.rows for one in ranges)
        ends = [end for one in ranges for end in (one.low, one.high) if end is not None]
        sample = _inside(keys, order_by, ranges).sample(min(1.0, SAMPLE_KEYS / left), seed)
        marked = keys.sparkSession.createDataFrame(list(dict.fromkeys(ends)), keys.schema)
        ordered = _sorted(sample.unionByName(marked), order_by)
        cuts = _proposed(ranges, [key for key in ordered if key not in set(ends)], left)
        chosen = {*ends, *cuts}
        lines = list(dict.fromkeys(key for key in ordered if key in chosen))
        ranges = _narrowed(keys, order_by, ranges, lines, found)
    if ranges:
        ordered = _sorted(_inside(keys, order_by, ranges), order_by)
        begin = 0
        for one in ranges:
            for place in one.wanted:
                found[place] = ordered[begin + place - one.before]
            begin += one.rows
    return found


def _sorted(keys: DataFrame, order_by: Sequence[str]) -> list[tuple]:
    """Few keys in Spark's order."""
    return [tuple(row) for row in keys.repartition(1).sortWithinPartitions(*order_by).collect()]


def _proposed(ranges: list[_Range], sampled: list[tuple], left: int) -> set[tuple]:
    """Sampled keys around each wanted place, some deviations of the sample to both sides."""
    share = len(sampled) / left
    spread = 2 * len(sampled) ** 0.5 + 2
    each = max(2, CUTS // sum(len(one.wanted) for one in ranges))
    cuts, seen = set(), 0
    for one in ranges:
        for place in one.wanted:
            middle = (seen + place - one.before) * share
            for step in range(each):
                at = round(middle + spread * (2 * step / (each - 1) - 1))
                cuts.add(min(max(at, 0), len(sampled) - 1))
        seen += one.rows
    return {sampled[at] for at in cuts if at >= 0}


def _narrowed(keys, order_by, ranges: list[_Range], lines: list[tuple], found: dict) -> list[_Range]:
    """The parts of the ranges that hold wanted places; places at a line go to ``found``.

    ``lines`` are keys in order, the ends of the ranges among them.
    """
    known = _keys_array(keys, order_by, lines)
    at = _reached(keys, order_by, lines)
    exact = F.coalesce(F.get(known, at - 1) == _own(keys, order_by), F.lit(False))
    # 2 i: between line i and the next one, 2 i - 1: at line i (from 1).
    bucket = 2 * at - F.when(exact, 1).otherwise(0)
    inside = _inside(keys, order_by, ranges).select(bucket.alias("bucket"))
    counts = {r["bucket"]: r["n"] for r in inside.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    place_of = {line: number + 1 for number, line in enumerate(lines)}
    out = []
    for one in ranges:
        first = 2 * place_of[one.low] if one.low is not None else 0
        last = 2 * place_of[one.high] - 2 if one.high is not None else 2 * len(lines)
        before = one.before
        for number in range(first, last + 1):
            n = counts.get(number, 0)
            here = tuple(place for place in one.wanted if before <= place < before + n)
            if here and number % 2:
                found.update(dict.fromkeys(here, lines[number // 2]))
            elif here:
                low = lines[number // 2 - 1] if number else None
                high = lines[number // 2] if number // 2 < len(lines) else None
                out.append(_Range(low, high, before, n, here))
            before += n
    return out


def _inside(df: DataFrame, order_by: Sequence[str], ranges: list[_Range]) -> DataFrame:
    """Rows that lie in one of the ranges, which are apart and in order."""

    def hull(one: _Range) -> Column:
        parts = [F.lit(True)]
        if one.low is not None:
            parts.append(_at_least(df, order_by[0], one.low[0]))
        if one.high is not None:
            parts.append(_at_most(df, order_by[0], one.high[0]))
        return reduce(Column.__and__, parts)

    def exactly(one: _Range) -> Column:
        parts = [hull(one)]
        if one.low is not None:
            parts.append(_own(df, order_by) > _key(df, order_by, one.low))
        if one.high is not None:
            parts.append(_own(df, order_by) < _key(df, order_by, one.high))
        return reduce(Column.__and__, parts)

    if len(ranges) <= _WINDOWS:
        return df.filter(reduce(Column.__or__, [exactly(one) for one in ranges]))
    df = df.filter(hull(_Range(ranges[0].low, ranges[-1].high, 0, 0, ())))
    lows = [one.low for one in ranges if one.low is not None]
    at = _reached(df, order_by, lows)
    own = _own(df, order_by)
    open_start = ranges[0].low is None
    number = at if open_start else at - 1  # position in ``ranges``
    highs = [one.high for one in ranges if one.high is not None]
    below = F.get(_keys_array(df, order_by, highs), number)
    on_low = F.get(_keys_array(df, order_by, lows), at - 1)
    inside = (number >= 0) & F.coalesce(own > on_low, F.lit(open_start))
    inside &= F.when(number < len(highs), own < below).otherwise(F.lit(len(highs) < len(ranges)))
    return df.filter(inside)


def _keys_at(
    df: DataFrame, order_by: Sequence[str], places: Sequence[int], rows: int | None = None
) -> dict[int, tuple]:
    """The key at each listed place that exists, which no other row may share."""
    wanted = {p for place in places for p in (place - 1, place)}
    keys = keys_at_places(df, order_by, sorted(wanted), rows)
    for place in places:
        if place in keys and keys.get(place - 1) == keys[place]:
            raise ValueError(f"order_by {list(order_by)} is not unique at position {place}")
    return {place: keys[place] for place in places if place in keys}


def _own(df: DataFrame, order_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(name) for name in order_by])


def _key(df: DataFrame, order_by: Sequence[str], key: tuple) -> Column:
    kinds = [df.schema[name].dataType for name in order_by]
    values = zip(key, kinds, order_by, strict=True)
    return F.struct(*[_literal(value, kind).alias(name) for value, kind, name in values])


def _literal(value, kind) -> Column:
    if isinstance(value, date) and not isinstance(value, datetime):
        value = value.isoformat()  # a date literal takes no years before 1000
    return F.lit(value).cast(kind)


def _keys_array(df: DataFrame, order_by: Sequence[str], keys: list[tuple]) -> Column:
    """The keys as one literal: many single ones would make a plan of thousands of nodes."""
    schema = df.select(*order_by).schema
    rows = df.sparkSession.createDataFrame(keys, schema).select(F.to_json(_own(df, order_by), _EXACT))
    text = ",".join(row[0] for row in rows.collect())
    return F.from_json(F.lit(f"[{text}]"), ArrayType(schema), _EXACT)


def _reached(df: DataFrame, order_by: Sequence[str], keys: list[tuple]) -> Column:
    """How many of the ordered keys are at or before a row's key, by halving."""
    if not keys:
        return F.lit(0)
    steps = [1 << bit for bit in reversed(range(len(keys).bit_length()))]
    lines, own = _keys_array(df, order_by, keys), _own(df, order_by)

    def halve(at: Column, step: Column) -> Column:
        further = at + step
        passed = (further <= len(keys)) & (F.get(lines, further - 1) <= own)
        return F.when(passed, further).otherwise(at)

    return F.aggregate(F.array(*[F.lit(step) for step in steps]), F.lit(0), halve)


def _at_least(df: DataFrame, name: str, value) -> Column:
    """A comparison of one column that a scan can use; nulls come first."""
    return F.lit(True) if value is None else F.col(name) >= _literal(value, df.schema[name].dataType)


def _at_most(df: DataFrame, name: str, value) -> Column:
    if value is None:
        return F.col(name).isNull()
    return F.col(name).isNull() | (F.col(name) <= _literal(value, df.schema[name].dataType))


def _from_key(df: DataFrame, order_by: Sequence[str], key: tuple) -> Column:
    """Whether a row's key is at or after ``key`` (nulls order first)."""
    own = _own(df, order_by) >= _key(df, order_by, key)
    return _at_least(df, order_by[0], key[0]) & own


def _before_key(df: DataFrame, order_by: Sequence[str], key: tuple) -> Column:
    own = _own(df, order_by) < _key(df, order_by, key)
    return _at_most(df, order_by[0], key[0]) & own
