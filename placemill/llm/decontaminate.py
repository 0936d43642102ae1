"""Benchmark decontamination by latent semantic retrieval.

1. The words of the benchmark items are the vocabulary. How many passages of the corpus
   hold each is counted over all documents; rare words weigh more (squared inverse
   document frequency), and words outside the vocabulary count nowhere.
   The same pass counts in how many passages each two words stand together.
2. Items are taken ``BLOCK`` at a time, fewer than the rank. For each block, a randomised
   singular value decomposition of TF-IDF passages (its items and all passages of all
   documents) gives a latent space. The products with the passage matrix are taken by the
   table of words that stand together, added up in tasks; the driver sees
   vocabulary of the block x rank, once a product.
3. Every document is cut into overlapping passages. The product of a passage and an item
   is the weight of the item's words in the passage. It is taken in the latent space, and
   the lengths of what lies outside bound what the space loses. A passage is a candidate
   if the product may reach the share of half the item's weight that one of the passages
   over a stretch must hold, so no stretch that holds half is missed, whatever the rank,
   the size of the corpus and the words around.
4. A candidate is a leak if the longest common subsequence of words covers enough of
   the item, or somewhat less and nearly all of its answer, its last sentence, and the
   words found carry at least half of the item's weight.

The items, a benchmark, are sent to the tasks ``ITEMS`` at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from placemill.llm import words as W
from placemill.llm.shared import free_worker, free_worker_once, give_back, stored

PASSAGE = 48
STRIDE = 24
RANK = 256
OVERSAMPLE = 16
ROUNDS = 2
#: Pairs of words that are made at once, and words of a range of the table of pairs.
_PAIRS, _RANGE = 1 << 20, 64
#: Blocks of a product that a task adds up, about half a megabyte.
_BLOCKS = 4
ITEMS = 4000
BLOCK = 200
_AT_ONCE = 64
#: Words whose pairs have codes of 32 bits.
_SMALL = 46_340
#: Share of a bound that rounding may take.
_SLACK = 0.999


def _found(column: pa.Array) -> W.Words:
    return W.words_of(column, lower=True, inside_of=W.letter_or_digit)


def _place(codes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Position of each word in the sorted vocabulary, or -1.

    Codes are well mixed: most words that are not in the vocabulary differ from all its words
    in their last 16 bits, and are not searched for.
    """
    out = np.full(len(codes), -1)
    if not len(vocabulary):
        return out
    may = np.zeros(1 << 16, bool)
    may[vocabulary.astype(np.uint16)] = True
    some = np.flatnonzero(may[codes.astype(np.uint16)])
    codes = codes[some]
    at = np.minimum(np.searchsorted(vocabulary, codes), len(vocabulary) - 1)
    same = vocabulary[at] == codes
    out[some[same]] = at[same]
    return out


def passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of every passage: half overlapping, all words of each text."""
    counts = np.diff(first)
    steps = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - PASSAGE) // STRIDE)), 0)
    text = np.repeat(np.arange(len(counts)), steps)
    inner = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
    begin = first[:-1][text] + inner * STRIDE
    return begin, np.minimum(begin + PASSAGE, first[1:][text]), text


@dataclass
class Space:
    """The latent space of a block of items."""

    #: Which items; for each word of all items (and none) its row of the basis or -1.
    items: np.ndarray
    local: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    #: Length of the part of each item outside the space.
    lost: np.ndarray


@dataclass
class Items:
    """Benchmark items: words, answers, weights and, once fitted, latent spaces."""

    ids: list
    codes: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray
    places: list[np.ndarray]
    #: For each item its distinct places in order, and which of them each of its words is.
    distinct: list[tuple[np.ndarray, np.ndarray]]
    idf: np.ndarray | None = None
    spaces: list[Space] | None = None

    def matrix(self, some: np.ndarray, local: np.ndarray, size: int) -> np.ndarray:
        """TF-IDF rows of some items over the words of their block."""
        rows = np.zeros((len(some), size))
        for row, one in zip(rows, some, strict=True):
            np.add.at(row, local[self.places[one]], self.idf[self.places[one]] ** 0.5)
        return rows

    def weights(self) -> np.ndarray:
        return np.array([self.idf[own].sum() for own in self.places])

    def shares(self) -> np.ndarray:
        """For each item, how many passages lie over any stretch compared with it."""
        return np.array([-(-(1 - (1 - _reach(len(own)) - 2) // STRIDE) // 2) for own in self.codes])


def _reach(words: int) -> int:
    """Words of a text in which an item of so many words is looked for."""
    return words + words // 4 + 2


def _last_sentence(text: str) -> str:
    parts = [part for part in text.replace("\n", " ").replace("? ", ". ").split(". ") if part.strip(" .")]
    return parts[-1] if parts else ""


def read_items(rows: list[tuple]) -> Items:
    """Items (id, text) without null or empty texts."""
    rows = [(key, text) for key, text in rows if text]
    found = _found(pa.array([text for _, text in rows], pa.string()))
    answers = _found(pa.array([_last_sentence(text) for _, text in rows], pa.string()))
    split = [
        [w.codes[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)] for w in (found, answers)
    ]
    has = [at for at, codes in enumerate(split[0]) if len(codes)]
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *split[0]]))
    codes, answers = ([side[at] for at in has] for side in split)
    places = [_place(own, vocabulary) for own in codes]
    distinct = [np.unique(own, return_inverse=True) for own in places]
    return Items([rows[at][0] for at in has], codes, answers, vocabulary, places, distinct)


class _Pairs:
    """How often each two words stand together, by codes ``word * size + other``, in order."""

    def __init__(self):
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """``codes`` must be distinct and in order."""
        if not len(self.codes):
            self.codes, self.counts = codes, counts
            return
        at = np.searchsorted(self.codes, codes)
        old = self.codes[np.minimum(at, len(self.codes) - 1)] == codes
        self.counts[at[old]] += counts[old]
        if not old.all():
            self.codes = np.insert(self.codes, at[~old], codes[~old])
            self.counts = np.insert(self.counts, at[~old], counts[~old])


def _counted(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(np.concatenate(codes))
    at = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)])
    return codes[at].astype(np.int64), np.diff(at, append=len(codes))


def _pairs_of(row: np.ndarray, word: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Codes of every two words of a row, each word with itself, too; rows and, in them,
    words must be in order."""
    word = word.astype(np.int64 if size > _SMALL else np.int32)  # half as wide, sorted twice as fast
    n = np.cumsum(np.bincount(row))[row] - np.arange(len(row))
    total = np.cumsum(n)
    cuts = np.searchsorted(total, np.arange(_PAIRS, total[-1] if len(total) else 0, _PAIRS))
    for some in np.split(np.arange(len(row)), np.unique(cuts)):
        if len(some):
            many = n[some]
            shift = np.repeat(some - (np.cumsum(many) - many), many)
            yield np.repeat(word[some] * word.dtype.type(size), many) + word[shift + np.arange(len(shift))]


def _together(docs: DataFrame, items: Items) -> DataFrame:
    """(range, codes, n): in how many of all passages each two words of the vocabulary are,
    a word and itself, too. Code -1 counts all passages. One row for each range of words."""
    size = len(items.vocabulary)

    def table(pairs: _Pairs) -> pa.RecordBatch:
        part = np.maximum(pairs.codes, 0) // (size * _RANGE)
        first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
        cuts = list(zip(first, [*first[1:], len(part)], strict=True))
        columns = [
            pa.array(part[first], pa.int32()),
            # small differences, which Spark's codec shrinks
            pa.array([np.diff(pairs.codes[a:b], prepend=0).tobytes() for a, b in cuts], pa.binary()),
            pa.array([pairs.counts[a:b].tobytes() for a, b in cuts], pa.binary()),
        ]
        return pa.record_batch(columns, ["range", "codes", "n"])

    def run(batches):
        free_worker()
        pairs, total, waiting = _Pairs(), 0, []
        for batch in batches:
            for a, b in W.pieces(batch.column(0)):
                found = _found(batch.column(0).slice(a, b - a))
                begin, end, _ = passages(found.first)
                total += len(begin)
                at = _place(found.codes, items.vocabulary)
                known, before = np.flatnonzero(at >= 0), np.r_[0, np.cumsum(at >= 0)]
                begin, end = before[begin], before[end]
                length = end - begin
                row = np.repeat(np.arange(len(begin)), length)
                word = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(len(row))
                key = row * np.int64(size) + at[known[word]]
                key.sort()
                key = key[np.flatnonzero(np.diff(key, prepend=-1))]
                for codes in _pairs_of(key // size, key % size, size):
                    waiting.append(codes)
                    if sum(map(len, waiting)) >= 4 * _PAIRS:
                        pairs.add(*_counted(waiting))
                        waiting = []
        if waiting:
            pairs.add(*_counted(waiting))
        pairs.add(np.array([-1]), np.array([total]))
        yield table(pairs)
        del pairs, waiting
        give_back()

    def merged(batches):
        sums: dict[int, _Pairs] = {}
        for batch in batches:
            for part, codes, n in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                own = sums.setdefault(part, _Pairs())
                own.add(np.cumsum(np.frombuffer(codes, np.int64)), np.frombuffer(n, np.int64).copy())
        for part in sorted(sums):
            yield table(sums[part])

    schema = "range int, codes binary, n binary"
    ranges = max(1, -(-size // _RANGE))
    found = docs.select("text").mapInArrow(run, schema)
    return found.repartition(ranges, "range").mapInArrow(merged, schema)


def _totals(together: DataFrame, size: int) -> dict[int, int]:
    """In how many passages each word is; -1: all passages."""

    def run(batches):
        for batch in batches:
            for data, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                codes, counts = np.cumsum(np.frombuffer(data, np.int64)), np.frombuffer(n, np.int64)
                own = (codes < 0) | (codes // size == codes % size)
                word = np.where(codes[own] < 0, -1, codes[own] // size)
                yield pa.record_batch([pa.array(word), pa.array(counts[own])], ["word", "n"])

    return {row["word"]: row["n"] for row in together.mapInArrow(run, "word long, n long").collect()}


def _product(together: DataFrame, root: np.ndarray, local: np.ndarray, right: np.ndarray) -> np.ndarray:
    """AᵀA ``right`` for the matrix A of all passages, summed over partitions.

    A partition gives its sums in blocks of ``_RANGE`` words, and tasks add up each block, in
    the order of the partitions. So the driver gets the product once, in small pieces, and
    not a whole matrix from every partition.
    """

    held = together.sparkSession.sparkContext.broadcast((root, local, right.astype(np.float32)))
    shape = right.shape

    def run(batches):
        root, local, right = held.value
        size, total = len(root), np.zeros(shape)
        for batch in batches:
            for data, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                codes, counts = np.cumsum(np.frombuffer(data, np.int64)), np.frombuffer(n, np.int64)
                codes, counts = codes[codes >= 0], counts[codes >= 0]
                one, other = codes // size, codes % size
                inside = (local[one] >= 0) & (local[other] >= 0)
                one, other = one[inside], other[inside]
                if not len(one):
                    continue
                words, row = np.unique(local[one], return_inverse=True)
                dense = np.zeros((len(words), shape[0]), np.float32)
                dense[row, local[other]] = counts[inside] * root[one] * root[other]
                total[words] += dense @ right
                dense[np.arange(len(words)), words] = 0
                total += dense.T @ right[words]
        part = TaskContext.get().partitionId()
        for first in range(0, shape[0], _RANGE):
            yield _sums_row([first, part, total[first : first + _RANGE].tobytes()], ["first", "part", "sums"])

    blocks = -(-shape[0] // _RANGE)
    found = together.mapInArrow(run, "first int, part int, sums binary")
    found = found.repartition(max(1, -(-blocks // _BLOCKS)), "first")
    found = found.sortWithinPartitions("first", "part").mapInArrow(_added, "first int, sums binary")
    total = np.zeros(shape)
    for batch in found.toArrow().to_batches():
        for first, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total[first : first + _RANGE] = np.frombuffer(data.as_buffer()).reshape(-1, shape[1])
    held.destroy()
    return total


def _sums_row(values: list, names: list[str]) -> pa.RecordBatch:
    kinds = [pa.binary() if name == "sums" else pa.int32() for name in names]
    return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, sums) for rows (first, part, sums) in order: the sums of equal ``first`` added up."""
    at, total = None, np.zeros(0)
    for batch in batches:
        for first, data in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            sums = np.frombuffer(data.as_buffer())
            if first != at:
                if at is not None:
                    yield _sums_row([at, total.tobytes()], ["first", "sums"])
                at, total = first, np.zeros(len(sums))
            total += sums
    if at is not None:
        yield _sums_row([at, total.tobytes()], ["first", "sums"])


def fit_latent(docs: DataFrame, items: Items) -> Items:
    """Weights and latent spaces from all passages of all documents, added to ``items``."""
    together = stored(_together(docs, items), "together").coalesce(8)
    found = _totals(together, len(items.vocabulary))
    total = found.pop(-1, 0)
    seen = np.zeros(len(items.vocabulary))
    seen[list(found)] = list(found.values())
    items.idf = np.log((total + 2) / (np.minimum(seen, total) + 1)) ** 2
    every = np.arange(len(items.codes))
    cuts = np.arange(BLOCK, len(every), BLOCK)
    items.spaces = [_space(together, seen, items, some) for some in np.split(every, cuts)]
    give_back()
    return items


def _space(together: DataFrame, seen: np.ndarray, items: Items, some: np.ndarray) -> Space:
    words = np.unique(np.concatenate([items.places[one] for one in some]))
    local = np.full(len(items.vocabulary) + 1, -1)
    local[words] = np.arange(len(words))
    root = items.idf**0.5
    own = items.matrix(some, local, len(words))
    # the items outweigh the passages, or their rare words would be the first to be lost
    length = np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)
    energy = float(seen[words] @ items.idf[words])
    weighted = own / length * 4 * max(1.0, energy / len(own)) ** 0.5
    right = np.random.default_rng(11).standard_normal((len(words), min(RANK + OVERSAMPLE, len(words))))

    def product(right):
        total = _product(together, root, local, right)
        total += weighted.T @ (weighted @ right)
        give_back()  # matrices of the driver that are done with
        return total

    for _ in range(ROUNDS + 1):
        right, _ = np.linalg.qr(product(right))
    core = right.T @ product(right)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    basis = right @ vectors[:, np.argsort(-values)[:RANK]]
    latent = own @ basis
    lost = np.linalg.norm(own - latent @ basis.T, axis=1)
    scaled = (basis * root[words][:, None]).astype(np.float32)
    return Space(some, local, scaled, latent.astype(np.float32), lost.astype(np.float32))


def common_subsequence(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the longest common subsequence, with one bit for each word of ``left``."""
    where: dict[int, int] = {}
    for at, code in enumerate(left.tolist()):
        where[code] = where.get(code, 0) | 1 << at
    row, full = 0, (1 << len(left)) - 1
    for code in right.tolist():
        match = where.get(code, 0)
        if match:
            both = row | match
            row = both & ~(both - ((row << 1) | 1)) & full
    return row.bit_count()


@dataclass
class Limits:
    covered: float = 0.7
    covered_with_answer: float = 0.55
    answer: float = 0.8
    weight: float = 0.5


def scan(column: pa.Array, items: Items, limits: Limits) -> Iterator[tuple]:
    """(row, item, cosine, covered, answered, first word, end word) for each leak."""
    need = limits.weight * items.weights() / items.shares()
    for a, b in W.pieces(column):
        found = _found(column.slice(a, b - a))
        begin, end, text = passages(found.first)
        at = _place(found.codes, items.vocabulary)
        inner = np.r_[0.0, np.cumsum(np.append(items.idf, 0.0)[at])]
        near = np.flatnonzero(inner[end] - inner[begin] >= need.min() * _SLACK)
        best: dict[tuple[int, int], tuple] = {}
        for p, one, cosine in _near_items(at, begin, end, near, items, need):
            leak = _confirmed(found, at, items, one, int(begin[p]), int(end[p]), int(text[p]), limits)
            key = int(text[p]), one
            if leak and (key not in best or leak[0] > best[key][1]):
                best[key] = (min(1.0, cosine), *leak)
        for (row, one), leak in sorted(best.items()):
            yield (a + row, items.ids[one], *leak)


def _numbered(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, below ``size``, in order, and which of them each value is."""
    seen = np.zeros(size, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[values]


def _sums(basis: np.ndarray, place: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """For each of ``rows`` passages the sum of the basis rows of its words, as a product.

    Passages overlap and share words, so each basis row is read once for all of them.
    """
    words, column = _numbered(place, len(basis))
    holds = np.zeros((rows, len(words)), np.float32)
    holds[row, column] = 1
    return holds @ basis[words]


def _near_items(at, begin, end, near, items: Items, need: np.ndarray) -> Iterator[tuple]:
    """(passage, item, cosine) for passages that may hold as much of an item as ``need``."""
    for some in np.array_split(near, len(near) // _AT_ONCE + 1):
        if not len(some):
            continue
        size = end[some] - begin[some]
        row = np.repeat(np.arange(len(some)), size)
        word = at[np.repeat(begin[some] - (np.cumsum(size) - size), size) + np.arange(len(row))]
        wide = len(some) * len(items.idf) > np.iinfo(np.int32).max
        key = (row * len(items.idf) + word)[word >= 0].astype(np.int64 if wide else np.int32)
        key.sort()
        key = key[np.flatnonzero(np.diff(key, prepend=-1))].astype(np.int64)
        row, word = key // len(items.idf), key % len(items.idf)
        length = np.bincount(row, items.idf[word], len(some)) ** 0.5
        for space in items.spaces:
            place = space.local[word]
            inside = place >= 0
            # A product is at most the weight of the passage's words of the block.
            held = np.bincount(row[inside], items.idf[word[inside]], len(some))
            inside &= (held >= need[space.items].min() * _SLACK)[row]
            rows, at_row = _numbered(row[inside], len(some))
            if not len(rows):
                continue
            vectors = _sums(space.basis, place[inside], at_row, len(rows))
            whole = held[rows]
            outside = np.maximum(whole - np.square(vectors, dtype=float).sum(axis=1), 0) ** 0.5
            products = vectors @ space.vectors.T
            least = (need[space.items] * _SLACK).astype(np.float32)
            may = products + outside.astype(np.float32)[:, None] * space.lost >= least
            hits = np.flatnonzero(may.any(axis=1))
            if not len(hits):
                continue
            # What is reported comes from sums in the order of the words.
            own = np.flatnonzero(np.isin(at_row, hits))
            first = np.flatnonzero(np.diff(at_row[own], prepend=-1))
            vectors[hits] = np.add.reduceat(space.basis[place[inside][own]], first, axis=0)
            products = vectors @ space.vectors.T
            for r, i in zip(*np.nonzero(may), strict=True):
                one = int(space.items[i])
                scale = length[rows[r]] * np.hypot(np.linalg.norm(space.vectors[i]), space.lost[i])
                yield int(some[rows[r]]), one, float(products[r, i] / max(scale, 1e-12))


def _confirmed(found, at, items, one, begin, end, text, limits):
    item, answer = items.codes[one], items.answers[one]
    reach = _reach(len(item))
    low = max(int(found.first[text]), begin - reach)
    high = min(int(found.first[text + 1]), end + reach)
    region = found.codes[low:high]
    own, which = items.distinct[one]
    here = at[low:high]
    place = np.minimum(np.searchsorted(own, here), len(own) - 1)
    hits = np.flatnonzero(own[place] == here)
    if len(hits) < limits.covered_with_answer * len(item):
        return None
    present = np.zeros(len(own), bool)
    present[place[hits]] = True
    weight = items.idf[own][which]
    if weight[present[which]].sum() < limits.weight * weight.sum():
        return None
    if common_subsequence(item, region) < limits.covered_with_answer * len(item):
        return None
    # stretches as long as the item and a quarter, those with most of its words first
    near = np.searchsorted(hits, hits + reach) - np.arange(len(hits))
    best = None
    for at_hit in np.argsort(-near, kind="stable").tolist():
        if near[at_hit] < max(limits.covered_with_answer, best[0] if best else 0) * len(item) - 2:
            break
        start = max(0, int(hits[at_hit]) - 2)
        stretch = region[start : int(hits[at_hit]) + reach]
        covered = common_subsequence(item, stretch) / len(item)
        if covered < limits.covered_with_answer or (best and covered <= best[0]):
            continue
        answered = common_subsequence(answer, stretch) / len(answer) if len(answer) else 0.0
        if covered >= limits.covered or answered >= limits.answer:
            first = low + start - int(found.first[text])
            best = covered, answered, first, first + len(stretch)
            if covered == 1:
                break
    return best


def _fitted(docs, benchmark, text_column, item_column, item_text) -> Iterator[Items]:
    source = docs.select(F.col(text_column).alias("text"))
    keyed = benchmark.select(F.col(item_column).alias("i"), F.col(item_text).alias("t"))
    blocks = -(-keyed.count() // ITEMS)
    for block in range(blocks):
        mine = keyed.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        items = read_items([tuple(row) for row in mine.collect()])
        if items.ids:
            yield fit_latent(source, items)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    limits: Limits | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row for each document and benchmark item that it holds, in whole or paraphrased.

    Columns: both ids, ``cosine`` of the best passage, ``covered`` and ``answered`` (parts
    of the item and of its last sentence found in order), and the stretch ``first_word``
    to ``end_word``. Words are runs of letters and digits, A-Z in lower case.

    Null or empty texts and items never match. Repeated rows each give their own rows. No
    documents or no items: no rows. Texts are never shuffled.
    """
    limits = limits or Limits()
    kinds = [docs.schema[id_column].dataType, benchmark.schema[item_column].dataType]
    names = [id_column, item_column if item_column != id_column else "item"]
    names += ["cosine", "covered", "answered", "first_word", "end_word"]
    schema = f"`{names[0]}` {kinds[0].simpleString()}, `{names[1]}` {kinds[1].simpleString()}, "
    schema += "cosine double, covered double, answered double, first_word long, end_word long"
    source = docs.select(F.col(id_column), F.col(text_column))
    done = docs.sparkSession.createDataFrame([], schema)
    for items in _fitted(docs, benchmark, text_column, item_column, item_text):
        held = docs.sparkSession.sparkContext.broadcast(items)

        done = done.unionAll(source.mapInArrow(_reporter(held, limits, names, kinds[1]), schema))
    return done


def _reporter(held, limits: Limits, names: list[str], item_type):
    kinds = [to_arrow_type(item_type), *[pa.float64()] * 3, *[pa.int64()] * 2]

    def run(batches):
        free_worker_once()
        for batch in batches:
            rows = list(scan(batch.column(1), held.value, limits))
            columns = [batch.column(0).take(pa.array([row[0] for row in rows], pa.int64()))]
            columns += [pa.array([row[at + 1] for row in rows], kind) for at, kind in enumerate(kinds)]
            yield pa.record_batch(columns, names)
            give_back()

    return run


def _tester(held, limits: Limits):
    def leaks(texts: pa.Array) -> pa.Array:
        free_worker_once()
        out = np.zeros(len(texts), bool)
        out[[row[0] for row in scan(texts, held.value, limits)]] = True
        give_back()
        return pa.array(out)

    return F.arrow_udf(leaks, "boolean")


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, limits: Limits | None = None, **columns) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; columns unchanged.

    The same test as :func:`find_leaks`, row by row, so no join moves the texts.
    """
    limits = limits or Limits()
    names = {"id_column": "doc_id", "text_column": "text", "item_column": "item_id", "item_text": "text"}
    names |= columns
    chosen = [names[one] for one in ("text_column", "item_column", "item_text")]
    for items in _fitted(docs, benchmark, *chosen):
        held = docs.sparkSession.sparkContext.broadcast(items)

        docs = docs.where(~_tester(held, limits)(F.col(names["text_column"])))
    return docs
