"""Substring deduplication by hashed windows, in groups by variable-length prefixes.

Every word position begins a window of ``window`` words. Windows with the same words are
a repeat, and every word that one covers in a document with a larger id than the
first is removed. No suffix tree is built: equal codes of windows stand for what would
be a tree's node at that depth, and repeats that go on beyond it are not listed as one.

1. A window's least gram (its minimizer) is the same in all windows
   with the same words, so windows whose least gram is found in one document only
   go first. Of the grams, one record for each bucket of documents
   and gram travels, with the smallest and largest id.
2. The windows that are left are dealt to groups by prefixes of one to
   four words, longer where a prefix is frequent in a sample. A group sorts its records;
   equal neighbours are the same window.
   Equal windows of a bucket travel as one, so a passage that stands in a third
   of all documents is one record for each bucket.
3. Each bucket reads the smallest id for its windows and drops the covered words.

The texts are shuffled once; all three passes read that shuffle. Buckets are sized by bytes
of text; the number of groups is that of shuffle partitions.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm import words as W
from placemill.llm.shared import bucket_of, free_name, free_worker_once, shuffle_partitions

#: Rows of the sample from which the prefixes of the groups are chosen. It bears on the
#: balance of the groups only, never on results.
SAMPLE_ROWS = 1000
#: Texts are dealt to buckets of about so many bytes, which tasks take one by one; at
#: least 2 and at most 32 a shuffle partition.
BUCKET_BYTES = 1 << 20
_LEAST_BUCKETS, _MOST_BUCKETS = 2, 32
_NULL_ID, _NO_ID = -(1 << 63), (1 << 63) - 1
_RECORDS = "part int, bucket int, high binary, low binary, least binary, span binary"
_REPLIES = "bucket int, part int, kind int, reply binary"


def prefix_codes(codes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys of all suffixes: 16 bits for each of four words, and the rest hashed."""
    count = max(0, len(codes) - window + 1)
    high = np.zeros(count, np.uint64)
    lead = min(4, window)
    for at in range(lead):
        high = (high << np.uint64(16)) | (codes[at : count + at] >> np.uint64(48))
    high <<= np.uint64(16 * (4 - lead))
    return high, W.runs(codes, window)


def group_prefixes(keys: np.ndarray, groups: int) -> np.ndarray:
    """Lower bounds of all groups but the first, as prefixes of whole words.

    Cuts the sorted sample into equal shares and shortens each cut to the fewest words
    that still tell it from the key before.
    """
    keys = np.sort(keys)
    if not len(keys) or groups < 2:
        return np.zeros(0, np.uint64)
    bounds = set()
    for at in np.linspace(0, len(keys), groups + 1)[1:-1].astype(int):
        key, before = int(keys[at]), int(keys[max(0, np.searchsorted(keys, keys[at]) - 1)])
        for length in (1, 2, 3, 4):
            cut = key >> (64 - 16 * length) << (64 - 16 * length)
            if cut > before:
                bounds.add(cut)
                break
    return np.array(sorted(bounds), np.uint64)


class _Piece:
    """Some texts of a bucket: grams, least grams and windows."""

    def __init__(self, table: pa.Table, id_column: str, text: str, window: int):
        self.window, size = window, window // 2 + 1
        self.words = W.words_of(table.column(text).combine_chunks())
        ids = table.column(id_column).combine_chunks().fill_null(_NULL_ID)
        ids = ids.cast(pa.int64()).to_numpy(zero_copy_only=False)
        self.owner = np.repeat(ids, self.words.counts())
        self.grams = W.runs(self.words.codes, size)
        self.whole = W.within(self.words.first, window)
        self.width = window - size + 1
        valid = W.within(self.words.first, size)
        self.least, chosen = W.minimizers(self.grams, valid, self.whole, self.width)
        self.anchors = np.flatnonzero(chosen)
        # Least grams are small numbers; mixed again they spread over all groups alike.
        self.keys = W.mix(self.grams[self.anchors])

    def suffixes(self, shared: np.ndarray):
        """Windows whose least gram's key is in ``shared`` (sorted), their keys and ids."""
        at = np.zeros(0, np.int64)
        if len(shared) and len(self.anchors):
            near = np.minimum(np.searchsorted(shared, self.keys), len(shared) - 1)
            seen = self.anchors[shared[near] == self.keys]
            hidden = np.full(len(self.grams), W.MOST)
            hidden[seen] = self.grams[seen]
            at = np.flatnonzero((W.sliding(hidden, self.width) == self.least) & self.whole)
        high, low = prefix_codes(self.words.codes, self.window)
        return at, high[at], low[at], self.owner[at]


def _texts(table: pa.Table, id_column: str, text: str, window: int) -> list[_Piece]:
    cuts = W.pieces(table.column(text).combine_chunks())
    return [_Piece(table.slice(a, b - a), id_column, text, window) for a, b in cuts]


def _unique(high: np.ndarray, low: np.ndarray, ids: np.ndarray):
    """Distinct keys in order, smallest and largest id of each, and each row's key."""
    order = np.lexsort((low, high)) if len(low) else np.argsort(high, kind="stable")
    new = np.ones(len(high), bool)
    new[1:] = high[order][1:] != high[order][:-1]
    if len(low):
        new[1:] |= low[order][1:] != low[order][:-1]
    at = np.flatnonzero(new)
    back = np.empty(len(high), np.int64)
    back[order] = np.cumsum(new) - 1
    if not len(at):
        return high, low, ids, ids, back
    least, most = np.minimum.reduceat(ids[order], at), np.maximum.reduceat(ids[order], at)
    return high[order][at], low[order][at] if len(low) else low, least, most, back


def _joined(parts: list[tuple]) -> tuple:
    return tuple(np.concatenate(side) for side in zip(*parts, strict=True))


def _grams_of(texts: list[_Piece]):
    """The distinct keys of a bucket's anchor grams in order, smallest and largest id of each."""
    grams, ids = _joined([(one.keys, one.owner[one.anchors]) for one in texts])
    high, _, least, most, _ = _unique(grams, grams[:0], ids)
    return high, least, most


def _share(keys: np.ndarray, parts: int) -> np.ndarray:
    """Equal ranges of 64-bit keys, in the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _shared_grams(grams: np.ndarray, parts: int, replies: list[dict]) -> np.ndarray:
    """Those of a bucket's grams that other documents have, too."""
    keep, share = np.zeros(len(grams), bool), _share(grams, parts)
    for row in replies:
        if row["kind"] == 1:
            begin, end = np.searchsorted(share, [row["part"], row["part"] + 1])
            bits = np.unpackbits(np.frombuffer(row["reply"], np.uint8), count=end - begin)
            keep[begin:end] = bits.astype(bool)
    return grams[keep]


def _planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second bytes and so on: what Spark's codec shrinks best."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(kind).ravel()


def _records(bucket: int, part: np.ndarray, high, low, least, most) -> pa.Table:
    """One row for each group that has records; keys and ``part`` must be in order."""
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else part
    rows: dict = {name: [] for name in ("part", "bucket", "high", "low", "least", "span")}
    for begin, end in itertools.pairwise([*cut, len(part)]):
        rows["part"].append(int(part[begin]))
        rows["bucket"].append(bucket)
        rows["high"].append(_planes(np.diff(high[begin:end], prepend=np.uint64(0))))
        rows["low"].append(low[begin:end].tobytes())
        rows["least"].append(_planes(least[begin:end]))
        rows["span"].append(_planes(most[begin:end] - least[begin:end]))
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.table([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], [*rows])


def _nodes(table: pa.Table):
    """The records of a group, for each its node's smallest and largest id, and the rows."""
    rows = table.to_pylist()
    found = [
        (
            np.cumsum(_from_planes(row["high"], np.uint64), dtype=np.uint64),
            np.frombuffer(row["low"], np.uint64),
            _from_planes(row["least"], np.int64),
            _from_planes(row["span"], np.int64),
        )
        for row in rows
    ]
    cuts = np.cumsum([len(one[0]) for one in found])[:-1]
    high, low, least, span = _joined(found)
    most = least + span
    node = _unique(high, low, least)[4]
    count = int(node.max()) + 1
    first, last = np.full(count, _NO_ID), np.full(count, _NULL_ID)
    np.minimum.at(first, node, least)
    np.maximum.at(last, node, most)
    return rows, cuts, most, first[node], last[node]


def _replies(rows: list[dict], kind: int, replies: list[bytes]) -> pa.Table:
    columns = {
        "bucket": pa.array([row["bucket"] for row in rows], pa.int32()),
        "part": pa.array([row["part"] for row in rows], pa.int32()),
        "kind": pa.array([kind] * len(rows), pa.int32()),
        "reply": pa.array(replies, pa.binary()),
    }
    return pa.table(columns)


def remove_repeats(
    docs: DataFrame, *, window: int = 13, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` without words of passages that a document with a smaller id has, too.

    A word goes if one of the windows of ``window`` words that cover it also begins in
    a document with a smaller id; windows are those of the input. Returns all columns,
    the text as the words that stay, joined by one space, and ``n_words`` and
    ``n_removed`` (long; underscores go in front where ``docs`` has such a column).

    Null text and text without words: 0 words, text "". Fewer words than ``window``:
    nothing goes. Ids must be integers; a null id is smaller than all others. Rows with
    the same id never count against each other. An empty table gives no rows.
    """
    if window < 2:
        raise ValueError("window must be 2 words or more")
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    size = docs.agg(F.sum(F.octet_length(F.col(text_column).cast("string")))).first()[0] or 0
    buckets = min(max(-(-size // BUCKET_BYTES), parts * _LEAST_BUCKETS), parts * _MOST_BUCKETS)
    bucket = free_name(docs, "bucket_no")
    n_words, n_removed = free_name(docs, "n_words"), free_name(docs, "n_removed")

    sample = docs.select(F.col(text_column).alias("t")).limit(SAMPLE_ROWS).toArrow().column("t")
    keys = [np.zeros(0, np.uint64)]
    for chunk in sample.chunks:
        for begin, end in W.pieces(chunk):
            found = W.words_of(chunk.slice(begin, end - begin))
            keys.append(prefix_codes(found.codes, window)[0][W.within(found.first, window)])
    bounds = group_prefixes(np.concatenate(keys), parts)

    dealt = docs.withColumn(bucket, bucket_of(id_column, buckets)).repartition(parts, bucket)

    def gram_records(key, table):
        free_worker_once()
        high, least, most = _grams_of(_texts(table, id_column, text_column, window))
        return _records(key[0].as_py(), _share(high, parts), high, high[:0], least, most)

    def gram_replies(table):
        """A bit for each gram: whether two documents have it."""
        free_worker_once()
        rows, cuts, _, first, last = _nodes(table)
        bits = [np.packbits(one).tobytes() for one in np.split(first < last, cuts)]
        return _replies(rows, 1, bits)

    def bucket_suffixes(table, replies):
        texts = _texts(table, id_column, text_column, window)
        shared = _shared_grams(_grams_of(texts)[0], parts, replies)
        found = [one.suffixes(shared) for one in texts]
        high, low, least, most, node = _unique(*_joined([one[1:] for one in found]))
        part = np.searchsorted(bounds, high, side="right")
        return texts, found, (part, high, low, least, most), node

    def suffix_records(key, left, right):
        free_worker_once()
        return _records(key[0].as_py(), *bucket_suffixes(left, right.to_pylist())[2])

    def suffix_replies(table):
        """The smallest id below each deep node, where a record has a larger one."""
        free_worker_once()
        rows, cuts, most, first, _ = _nodes(table)
        first = np.where(first < most, first, _NO_ID)
        return _replies(rows, 2, [_planes(one) for one in np.split(first, cuts)])

    result = docs.withColumn(n_words, F.lit(0).cast("long"))
    result = result.withColumn(n_removed, F.lit(0).cast("long")).withColumn(
        text_column, F.col(text_column).cast("string")
    )
    names = result.columns

    def cleaned(left, right):
        free_worker_once()
        replies = right.to_pylist()
        texts, found, (part, *_), node = bucket_suffixes(left, replies)
        first = np.full(len(part), _NO_ID)
        for row in replies:
            if row["kind"] == 2:
                begin, end = np.searchsorted(part, [row["part"], row["part"] + 1])
                first[begin:end] = _from_planes(row["reply"], np.int64)
        counts, gone, kept, done = [], [], [], 0
        for one, (at, _, _, ids) in zip(texts, found, strict=True):
            at = at[first[node[done : done + len(at)]] < ids]
            done += len(ids)
            edge = np.bincount(at, minlength=len(one.words.codes) + window + 1)
            edge[window:] -= edge[:-window].copy()
            stays = np.cumsum(edge)[: len(one.words.codes)] == 0
            for row, (begin, end) in enumerate(itertools.pairwise(one.words.first.tolist())):
                words, stay = one.words.text(row).split(), stays[begin:end]
                left_over = int(stay.sum())
                if left_over < len(words):
                    words = itertools.compress(words, stay.tolist())
                kept.append(b" ".join(words).decode())
                counts.append(end - begin)
                gone.append(end - begin - left_over)
        new = {
            text_column: pa.array(kept, pa.string()),
            n_words: pa.array(counts, pa.int64()),
            n_removed: pa.array(gone, pa.int64()),
        }
        return pa.table([new[n] if n in new else left.column(n) for n in names], names)

    grams = dealt.groupBy(bucket).applyInArrow(gram_records, _RECORDS)
    shared = grams.groupBy("part").applyInArrow(gram_replies, _REPLIES)
    texts = dealt.groupBy(bucket)
    suffixes = texts.cogroup(shared.groupBy("bucket")).applyInArrow(suffix_records, _RECORDS)
    firsts = suffixes.groupBy("part").applyInArrow(suffix_replies, _REPLIES)
    replies = shared.unionByName(firsts)
    return texts.cogroup(replies.groupBy("bucket")).applyInArrow(
        cleaned, result.schema
    )
