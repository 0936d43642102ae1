"""Spelling variants: words one edit apart, grouped under their commonest spelling.

Words are points: how often each letter occurs. One edit changes at most two counts by
one, so the L1 distance is at most two: one letter more and one less at the same length, one
more or one less at neighbouring lengths. A k-d tree over all words of a length, cut off
at cells that fit a task, sends every word to the cells whose boxes it can reach in that
way; in a cell a deeper tree of the same kind finds the points, and the order of the letters
decides.

Splits are "at least k of a letter", and a path never asks the same twice. So the unmet
splits on the way to a box, counted apart for letters to add and to drop, bound the
distance to it from below.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm import words as W
from placemill.llm.checksums import crc32_spans
from placemill.llm.shared import stored
from placemill.operators.spread import spread_join

#: Words of a cell of the upper tree, one task's share of points.
CELL_WORDS = 4096
#: The upper trees are fitted on at most so many words; their splits only decide balance.
SAMPLE_WORDS = 200_000
_SAMPLE_A_CELL = 64
_LEAF = 32
_TEXT_BYTES = 4 << 20
_LEAD = 0xC3  # first byte of the characters U+00C0 to U+00FF

#: (length of the points less that of the word) to letters that may be added and dropped.
REACH = {-1: (0, 1), 0: (1, 1), 1: (1, 0)}


def _letter(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of the characters U+00C0 to U+00FF."""
    small = data | 32
    lead = data == _LEAD
    after = np.zeros(len(data), bool)
    after[1:] = lead[:-1]
    return ((small >= 97) & (small <= 122) & (data < 128)) | lead | after


def _points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The spans as bytes of one a character, on end, and where each begins."""
    sizes = ends - starts
    inside = np.repeat(starts - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    raw = data[inside]
    lead = raw == _LEAD
    wide = np.zeros(len(raw), bool)
    wide[1:] = lead[:-1]
    flat = np.where(wide, raw + np.uint8(64), raw)[~lead]
    kept = np.r_[0, np.cumsum(~lead)]
    return flat, kept[np.r_[0, np.cumsum(sizes)]]


def _as_strings(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The reverse of ``_points``: an Arrow column of strings."""
    wide = (flat >= 128).astype(np.int64)
    place = np.arange(len(flat)) + np.cumsum(wide)
    raw = np.zeros(len(flat) + int(wide.sum()), np.uint8)
    raw[place] = np.where(wide == 1, flat - np.uint8(64), flat)
    raw[place[wide == 1] - 1] = _LEAD
    cuts = offsets + np.r_[0, np.cumsum(wide)][offsets]
    buffers = [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(raw)]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)


def _dropped(column: pa.Array, ids: list, least: int, every: int | None) -> pa.Array:
    """The runs of letters of all texts of at least ``least`` letters, after deletions."""
    data, offsets = W.text_bytes(column)
    data = W.lower_ascii(data)
    starts, ends = W.spans(data, offsets, _letter)
    if every:
        owner = np.repeat(np.arange(len(column)), np.diff(np.searchsorted(starts, offsets)))
        heads = [zlib.crc32(f"{'' if key is None else key}:".encode()) for key in ids]
        code = crc32_spans(data, starts, ends, np.array(heads, np.uint32)[owner])
    flat, cuts = _points(data, starts, ends)
    sizes = np.diff(cuts)
    keep = np.ones(len(flat), bool)
    if every:
        hit = np.flatnonzero(code % np.uint32(every) == 0)
        keep[cuts[hit] + code[hit].astype(np.int64) % sizes[hit]] = False
        sizes[hit] -= 1
    long = sizes >= least
    keep &= np.repeat(long, np.diff(cuts))
    return _as_strings(flat[keep], np.r_[0, np.cumsum(sizes[long])])


def word_counts(
    docs: DataFrame, *, id_column: str, text_column: str, least_letters: int, drop_every: int | None
) -> DataFrame:
    """(word, n) over all texts, added up in each task before the shuffle."""

    def run(batches):
        for batch in batches:
            for begin, end in W.pieces(batch.column(1), _TEXT_BYTES):
                part = batch.slice(begin, end - begin)
                ids = part.column(0).to_pylist()
                found = _dropped(part.column(1), ids, least_letters, drop_every)
                counts = found.value_counts()
                word, n = counts.field("values"), counts.field("counts")
                yield pa.record_batch([word.cast(pa.string()), n.cast(pa.int64())], ["word", "n"])

    chosen = docs.select(F.col(id_column).cast("string"), F.col(text_column).cast("string"))
    return chosen.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters of an Arrow string column, on end, and where each word begins."""
    data, offsets = W.text_bytes(column)
    return _points(data, offsets[:-1], offsets[1:])


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """How often each of 256 letters occurs in the rows of a matrix of letters."""
    counts = np.zeros((len(letters), 256), np.uint16)
    rows = np.arange(len(letters))
    for at in range(letters.shape[1]):
        counts[rows, letters[:, at]] += 1
    return counts


@dataclass
class Tree:
    """A k-d tree: nodes ask "at least ``level`` of ``letter``"; leaves have number ``leaf``."""

    letter: list[int]
    level: list[int]
    less: list[int]
    more: list[int]
    leaf: list[int]
    leaves: int = 0

    def _node(self, leaf: int = -1) -> int:
        for values, first in (
            (self.letter, 0), (self.level, 0), (self.less, -1), (self.more, -1), (self.leaf, leaf)
        ):
            values.append(first)
        return len(self.leaf) - 1


def _split(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and level that part the rows most evenly; none if all rows are equal."""
    middle = np.partition(counts, len(counts) // 2, axis=0)[len(counts) // 2]
    best = None
    for level in (middle, middle + 1):
        share = (counts >= level).mean(axis=0)
        share[(share == 0) | (share == 1)] = 2
        letter = int(np.argmin(np.abs(share - 0.5)))
        if share[letter] < 1 and (best is None or abs(share[letter] - 0.5) < best[0]):
            best = abs(share[letter] - 0.5), letter, int(level[letter])
    return best[1:] if best else None


def grow(counts: np.ndarray, leaf_rows: int) -> tuple[Tree, list[np.ndarray]]:
    """A tree over the rows with leaves of about ``leaf_rows``, and the rows of each leaf."""
    tree, members = Tree([], [], [], [], []), []
    waiting = [(np.arange(len(counts)), -1, False)]
    while waiting:
        rows, parent, above = waiting.pop()
        cut = _split(counts[rows]) if len(rows) > leaf_rows else None
        here = tree._node(-1 if cut else tree.leaves)
        if parent >= 0:
            (tree.more if above else tree.less)[parent] = here
        if cut is None:
            members.append(rows)
            tree.leaves += 1
            continue
        tree.letter[here], tree.level[here] = cut
        side = counts[rows, cut[0]] >= cut[1]
        waiting += [(rows[~side], here, False), (rows[side], here, True)]
    return tree, members


def reached(tree: Tree, counts: np.ndarray, add: int, drop: int):
    """Leaves and the rows that reach them with ``add`` letters more and ``drop`` less."""
    rows = np.arange(len(counts))
    waiting = [(0, rows, np.zeros(len(rows), np.int8), np.zeros(len(rows), np.int8))]
    while waiting:
        node, rows, more, less = waiting.pop()
        if not len(rows):
            continue
        if tree.leaf[node] >= 0:
            yield tree.leaf[node], rows
            continue
        has = counts[rows, tree.letter[node]] >= tree.level[node]
        up, down = more + ~has, less + has
        into = has | (up <= add)
        waiting.append((tree.more[node], rows[into], np.where(has, more, up)[into], less[into]))
        into = ~has | (down <= drop)
        waiting.append((tree.less[node], rows[into], more[into], np.where(has, down, less)[into]))


def _unary(counts: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Counts as bits, ``most`` a letter, packed: L1 distances are counts of unlike bits."""
    letters = np.repeat(np.arange(len(most)), most)
    levels = np.arange(len(letters)) - np.repeat(np.cumsum(most) - most, most) + 1
    width = -(-max(1, len(letters)) // 64) * 64
    bits = np.zeros((len(counts), width), bool)
    bits[:, : len(letters)] = counts[:, letters] >= levels.astype(np.uint16)
    return np.packbits(bits, axis=1).view(np.uint64)


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words of equal length differ in one place."""
    return (a != b).sum(axis=1) == 1


def _inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the longer words are the shorter ones with one letter put in."""
    size = short.shape[1]
    begin = np.logical_and.accumulate(short == long[:, :size], axis=1).sum(axis=1)
    end = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return begin + end >= size


def near_pairs(points: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (point, other) of words one edit apart.

    Points have one length, ``others`` the same or one letter more or less.
    """
    gap = points.shape[1] - others.shape[1]
    counts, their = letter_counts(points), letter_counts(others)
    used = counts.any(axis=0) | their.any(axis=0)
    counts, their = counts[:, used], their[:, used]
    most = np.maximum(counts.max(axis=0), their.max(axis=0)).astype(np.int64)
    bits, bits_of_others = _unary(counts, most), _unary(their, most)
    tree, members = grow(counts, _LEAF)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for leaf, rows in reached(tree, their, *REACH[gap]):
        here = members[leaf]
        for begin in range(0, len(rows), 1 << 15):
            block = rows[begin : begin + (1 << 15)]
            apart = np.zeros((len(block), len(here)), np.uint16)
            for word in range(bits.shape[1]):
                apart += np.bitwise_count(
                    bits_of_others[block, word][:, None] ^ bits[here, word][None, :]
                )
            which, point = np.nonzero(apart == (1 if gap else 2))
            point, other = here[point], block[which]
            a, b = points[point], others[other]
            same = _replaced(a, b) if gap == 0 else _inserted(*((b, a) if gap > 0 else (a, b)))
            found.append((point[same], other[same]))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _by_length(flat: np.ndarray, cuts: np.ndarray):
    """(length, rows, matrix of letters) of the words of each length."""
    sizes = np.diff(cuts)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield size, rows, flat[cuts[rows][:, None] + np.arange(size)]


def _upper_trees(words: DataFrame) -> dict[int, tuple[int, Tree]]:
    """For each length, the first cell's number and a tree whose leaves are the cells."""
    sizes = {row["size"]: row["n"] for row in words.groupBy("size").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    share = min(1.0, _SAMPLE_A_CELL / CELL_WORDS, SAMPLE_WORDS / max(1, total))
    cut = [size for size, n in sizes.items() if n > CELL_WORDS]
    parts = 1_000_000
    chosen = F.pmod(F.xxhash64("word"), F.lit(parts)) < max(1, round(share * parts))
    sample = words.where(F.col("size").isin(cut) & chosen).select("word").toArrow()
    column = pa.chunked_array(sample.column(0)).combine_chunks().cast(pa.large_string())
    counts = {size: letter_counts(rows) for size, _, rows in _by_length(*letter_rows(column))}
    trees, first = {}, 0
    for size in sorted(sizes):
        rows = counts.get(size, np.zeros((1, 256), np.uint16))
        cells = -(-sizes[size] // CELL_WORDS)
        tree, _ = grow(rows, max(1, -(-len(rows) // cells)))
        trees[size] = first, tree
        first += tree.leaves
    return trees


_ROUTED = "cell long, word string, n long, home boolean"
_NEAR = "word string, n_near long, best_n long, best string"


def _route(words: DataFrame, trees: dict[int, tuple[int, Tree]]) -> DataFrame:
    """Every word once in its own cell, and once in each other cell that it can reach."""

    def run(batches):
        for batch in batches:
            column = batch.column(0)
            out = []
            for size, rows, letters in _by_length(*letter_rows(column)):
                counts = letter_counts(letters)
                for gap, reach in REACH.items():
                    if size + gap not in trees:
                        continue
                    first, tree = trees[size + gap]
                    own = np.full(len(rows), -1)
                    if gap == 0:
                        for leaf, inside in reached(tree, counts, 0, 0):
                            own[inside] = leaf
                    for leaf, inside in reached(tree, counts, *reach):
                        out.append((np.full(len(inside), first + leaf), rows[inside], own[inside] == leaf))
            if out:
                cell, row, home = (np.concatenate(side) for side in zip(*out, strict=True))
                picked = batch.take(pa.array(row))
                yield pa.record_batch(
                    [pa.array(cell), picked.column(0), picked.column(1), pa.array(home)],
                    ["cell", "word", "n", "home"],
                )

    return words.select("word", "n").mapInArrow(run, _ROUTED)


def _search_cell(table: pa.Table) -> pa.Table:
    """For the words sent to a cell, how many of its points are near and the commonest one."""
    flat, cuts = letter_rows(table.column("word").combine_chunks())
    home = table.column("home").to_numpy()
    n = table.column("n").to_numpy()
    at_home = np.flatnonzero(home)
    out = [(np.zeros(0, np.int64),) * 3]
    if len(at_home):
        size = int(cuts[at_home[0] + 1] - cuts[at_home[0]])
        points = flat[cuts[at_home][:, None] + np.arange(size)]
        order = np.lexsort((*points.T[::-1], -n[at_home]))  # commonest first, then by letters
        at_home, points = at_home[order], points[order]
        for _, rows, letters in _by_length(flat, cuts):
            point, other = near_pairs(points, letters)
            seen, counted = np.unique(other, return_counts=True)
            best = np.full(len(rows), len(points))
            np.minimum.at(best, other, point)
            out.append((rows[seen], counted, at_home[best[seen]]))
    row, counted, best = (np.concatenate(side).astype(np.int64) for side in zip(*out, strict=True))
    names = table.column("word").cast(pa.string())
    return pa.table(
        {
            "word": names.take(pa.array(row)),
            "n_near": pa.array(counted),
            "best_n": table.column("n").take(pa.array(best)),
            "best": names.take(pa.array(best)),
        }
    )


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form), each followed to its last, by doubling.

    A form is more common than its word, so links have no cycle, and by a factor of more
    than one each time, so few rounds are needed.
    """
    now = stored(links.select("word", F.col("form").alias("root")), "links")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = spread_join(now, ahead, ["root"], "left")
        step = further.select(
            "word",
            F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved"),
        )
        step = stored(step, "links")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def spelling_variants(
    docs: DataFrame,
    *,
    least_letters: int = 7,
    least_n: int = 2,
    times: int = 10,
    drop_every: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row a word: word, n, n_near, form, form_n and root.

    Words are the runs of A-Z, a-z and U+00C0 to U+00FF of whole texts, with A-Z in lower case, of
    at least ``least_letters`` letters that occur at least ``least_n`` times. Two are near
    if one letter inserted, deleted or replaced makes one of the other. The form of a word is its near
    word with the largest n (ties: first in code-point order) if that is at least ``times``
    its own n, which must be 2 or more; the root is the end of the chain of forms, the word
    itself if it has none. ``n_near`` is 0 without near words.

    ``drop_every`` makes test typos: where it divides the CRC-32 of ``id:run``, one letter of
    the run is left out. A null id counts as empty text there; it plays no other part, nor do
    repeated ids, and rows that repeat a text count again. Null and empty texts have no
    words; no words: no rows. Other columns of ``docs`` do not matter.
    """
    if times < 2 or least_letters < 1:
        raise ValueError("need times of 2 or more and least_letters of 1 or more")
    counted = word_counts(
        docs, id_column=id_column, text_column=text_column, least_letters=least_letters,
        drop_every=drop_every,
    )
    words = counted.where(F.col("n") >= least_n).withColumn("size", F.char_length("word"))
    words = stored(words, "words")
    routed = _route(words, _upper_trees(words))
    found = routed.groupBy("cell").applyInArrow(_search_cell, _NEAR)
    near = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("down"), "best")).alias("best"),
    )
    wins = -F.col("best.down") >= times * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(wins, F.col("best.best")).alias("form"),
        F.when(wins, -F.col("best.down")).alias("form_n"),
    )
    formed = stored(formed, "formed")
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
