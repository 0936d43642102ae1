"""Near-duplicates: many universal hash minima, banding, verification, components.

1. One pass over the texts gives each document its number of distinct shingles, a
   digest of its word sequence, ``bands * rows`` minima of universal hash functions
   (16 bits of each are kept as the signature) and a key for each band.
2. Documents with the same words form a class; its smallest id stands for it.
3. In each band bucket the smallest id is the leader. A document is compared with its
   smallest leader first, then with leaders of its other buckets that the first links
   did not join. All links are confirmed on the full shingle sets.
4. Buckets that still hold several components give the rest: documents of different
   components, block against block, are compared on their full sets if their signatures
   agree often enough. So no link is lost because a leader did not fit.
5. Components by large-star and small-star.

A bucket is never gathered: leaders come from grouped minima, comparisons are grouped
by leader in chunks of ``CHUNK`` documents, the rest in ``BLOCK`` by ``PART`` or by
``VOLUME`` shingles. No pairs of the rest are written, only links that join components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm import words as W
from placemill.llm.components import components
from placemill.llm.shared import free_worker, give_back, id_filter, shuffle_partitions, stored
from placemill.operators.spread import spread_join
from placemill.runtime import broadcast_if_small

CHUNK = 64
BLOCK = 4096
PART = 4096
VOLUME = 2_000_000


def multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of ``count`` multiply-shift hash functions, fixed by a seed."""
    draw = np.random.default_rng(20240607)
    odd = draw.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 1 << 63, count, dtype=np.uint64)


def shingle_codes(found: W.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all shingles, text after text, and where each text's begin.

    A text with fewer words than ``size`` has its whole word sequence as one shingle, a
    text without words none.
    """
    counts = found.counts()
    runs = W.runs(found.codes, size)[W.within(found.first, size)]
    sizes = np.maximum(counts - size + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return runs, np.r_[0, np.cumsum(sizes)]
    whole = np.zeros(len(short), np.uint64)
    for at in range(size - 1):
        here = counts[short] > at
        word = found.codes[np.minimum(found.first[short] + at, len(found.codes) - 1)]
        whole = np.where(here, W.mix(whole + word), whole)
    place = np.cumsum(sizes)[short]
    sizes[short] = 1
    return np.insert(runs, place, whole), np.r_[0, np.cumsum(sizes)]


def distinct_sets(codes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    return [np.unique(codes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def minima(codes: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """(texts, count) minima of the hash functions; texts must not be empty of shingles."""
    odd, add = multipliers(count)
    out = np.empty((len(first) - 1, count), np.uint32)
    for at in range(count):
        values = (codes * odd[at] + add[at]) >> np.uint64(32)
        out[:, at] = np.minimum.reduceat(values, first[:-1])
    return out


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 63-bit key for each text and band."""
    parts = least.reshape(len(least), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for at in range(rows):
        keys = W.mix(keys + parts[:, :, at])
    return (keys >> np.uint64(1)).astype(np.int64)


def _long_lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int64()))


def sketches(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc, n_shingles, digest, signature, keys) for every row of ``docs`` (doc, text)."""

    def run(batches):
        free_worker()
        for batch in batches:
            for begin, end in W.pieces(batch.column(1)):
                part = batch.slice(begin, end - begin)
                found = W.words_of(part.column(1), lower=True)
                codes, first = shingle_codes(found, shingle)
                sizes = np.array([len(one) for one in distinct_sets(codes, first)], np.int64)
                full = np.flatnonzero(sizes)
                least = minima(codes, np.r_[first[:-1][full], len(codes)], bands * rows)
                keys = np.where(sizes > 0, bands, 0)
                signature, at = [None] * len(sizes), 0
                for row in full.tolist():
                    signature[row] = least[at].astype(np.uint16).tobytes()
                    at += 1
                digests = [
                    hashlib.blake2b(b" ".join(found.text(row).split()), digest_size=16).digest()
                    for row in range(len(sizes))
                ]
                yield pa.record_batch(
                    [
                        part.column(0),
                        pa.array(sizes),
                        pa.array(digests, pa.binary()),
                        pa.array(signature, pa.binary()),
                        _long_lists(band_keys(least, bands, rows).ravel(), keys),
                    ],
                    ["doc", "n_shingles", "digest", "signature", "keys"],
                )
            give_back()

    schema = "doc long, n_shingles long, digest binary, signature binary, keys array<long>"
    return docs.mapInArrow(run, schema)


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose full shingle sets are alike enough.

    Grouped by a in chunks of b: a group holds one text at a time and the set of a.
    """
    parts = shuffle_partitions(docs.sparkSession)
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    members = spread_join(pairs, counts, ["a"], "inner")
    chunk = F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int")
    members = members.select("a", chunk.alias("chunk"), F.col("b").alias("doc"))
    leaders = members.select("a", "chunk").distinct().select("a", "chunk", F.col("a").alias("doc"))
    wanted = stored(members.unionAll(leaders), "pairs")
    needed = docs.join(id_filter(wanted.select("doc"), "ids"), "doc", "left_semi")
    text = needed.join(broadcast_if_small(wanted), "doc").select(
        "a", "chunk", F.col("doc") != F.col("a"), "doc", "text"
    )
    text = text.toDF("a", "chunk", "member", "doc", "text")
    grouped = text.repartition(parts, "a", "chunk").sortWithinPartitions("a", "chunk", "member")

    def run(batches):
        leader: list = [None, None]
        for batch in batches:
            for begin, end in W.pieces(batch.column(4)):
                part = batch.slice(begin, end - begin)
                sets = distinct_sets(*shingle_codes(W.words_of(part.column(4), lower=True), shingle))
                rows = zip(*[part.column(at).to_pylist() for at in (0, 2, 3)], sets, strict=True)
                hit = []
                for a, member, doc, one in rows:
                    if not member:
                        leader = [a, one]
                    elif leader[0] == a:
                        both = len(np.intersect1d(leader[1], one, assume_unique=True))
                        if 100 * both >= percent * (len(leader[1]) + len(one) - both) > 0:
                            hit.append((a, doc))
                if hit:
                    yield pa.record_batch(
                        [pa.array([x[at] for x in hit], pa.int64()) for at in (0, 1)], ["a", "b"]
                    )

    return grouped.mapInArrow(run, "a long, b long").distinct()


def _dealt(labelled: DataFrame) -> DataFrame:
    """Rows of ``labelled`` (key, band, doc, component, n_shingles) dealt to the groups
    (key, block, part) in which documents of different components meet.

    In a bucket with several components, the documents outside its largest one are
    compared with all: a block of them (few) and a part of all are one group, so the rows
    of a bucket travel once while few of them are outside. A group holds ``BLOCK`` and
    ``PART`` documents or ``VOLUME`` shingles of each kind, whichever is less.
    """
    sizes = labelled.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("volume")
    )
    mixed = sizes.groupBy("key").agg(
        F.sum("n").alias("total"),
        F.sum("volume").alias("all"),
        F.max(F.struct("n", "volume", F.col("component").alias("main"))).alias("top"),
    )

    def groups(documents, most, volume):
        return F.ceil(F.greatest(documents / most, volume / VOLUME)).cast("int")

    n_outside, v_outside = F.col("total") - F.col("top.n"), F.col("all") - F.col("top.volume")
    mixed = mixed.where(n_outside > 0).select(
        "key",
        F.col("top.main").alias("main"),
        groups(n_outside, BLOCK, v_outside).alias("blocks"),
        groups(F.col("total"), PART, F.col("all")).alias("parts"),
    )
    rows = labelled.join(broadcast_if_small(stored(mixed, "mixed")), "key")
    outside = F.col("component") != F.col("main")
    code = F.xxhash64("doc")
    block = F.pmod(code, F.col("blocks")).cast("int").alias("block")
    part = F.pmod(code, F.col("parts")).cast("int").alias("part")
    kept = ["key", "band", "doc", "component", outside.alias("outside")]
    all_parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    all_blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    few = rows.where(outside).select(*kept, block, all_parts, F.lit(True).alias("few"))
    many = rows.select(*kept, all_blocks, part, F.lit(False).alias("few"))
    return few.unionByName(many)


def _near_rows(table: pa.Table, label: np.ndarray, bands: int, least_equal: int) -> Iterator[tuple]:
    """(row, rows) of a group: one of the few, and others of another ``label`` whose
    signatures agree often enough and that share this band as their first one."""
    few, docs, outside = (table.column(name).to_numpy() for name in ("few", "doc", "outside"))
    band = table.column("band")[0].as_py()
    raw = b"".join(table.column("signature").to_pylist())
    marks = np.frombuffer(raw, np.uint16).reshape(len(docs), -1)
    others = np.flatnonzero(~few)
    for at in np.flatnonzero(few).tolist():
        near = (label[others] != label[at]) & (~outside[others] | (docs[others] > docs[at]))
        near = others[near]
        same = marks[near] == marks[at]
        often = same.sum(axis=1) >= least_equal
        alike = same[often].reshape(-1, bands, same.shape[1] // bands).all(axis=2)
        near = near[often][alike.argmax(axis=1) == band]
        if len(near):
            yield at, near


def _rest_links(
    labelled: DataFrame,
    sketch: DataFrame,
    docs: DataFrame,
    *,
    shingle: int,
    percent: int,
    bands: int,
    least_equal: int,
) -> DataFrame:
    """Links (a, b) that join all documents of different components that are alike enough.

    Signatures find the documents of a group that have a partner there. Only their texts
    travel to the group; their full sets are compared in it. A group gives the links that
    join components not yet joined there, so it never has more links than documents.
    """
    grouped = _dealt(labelled).join(sketch.select("doc", "signature"), "doc")
    names = ["key", "block", "part", "band", "doc", "component", "outside", "few", "signature"]

    def marked(table):
        label = table.column("component").to_numpy()
        wanted = np.zeros(len(table), bool)
        for at, near in _near_rows(table, label, bands, least_equal):
            wanted[at] = True
            wanted[near] = True
        return table.select(names).filter(pa.array(wanted))

    schema = "key long, block int, part int, band int, doc long, component long, "
    schema += "outside boolean, few boolean, signature binary"
    met = stored(grouped.groupBy("key", "block", "part").applyInArrow(marked, schema), "met")
    needed = docs.join(id_filter(met.select("doc"), "ids"), "doc", "left_semi")
    texts = needed.join(broadcast_if_small(met), "doc")

    def linked(table):
        label = table.column("component").to_numpy().copy()
        docs = table.column("doc").to_numpy()
        texts = table.column("text").combine_chunks()
        sets = []
        for begin, end in W.pieces(texts):
            found = W.words_of(texts.slice(begin, end - begin), lower=True)
            sets += distinct_sets(*shingle_codes(found, shingle))
        sizes = np.array([len(one) for one in sets])
        codes, flat = np.unique(np.concatenate(sets), return_inverse=True)
        sets = np.split(flat, np.cumsum(sizes)[:-1])
        inside = np.zeros(len(codes), np.int64)
        hits: list[tuple[int, int]] = []
        for at, near in _near_rows(table, label, bands, least_equal):
            inside[sets[at]] = 1
            cuts = np.r_[0, np.cumsum(sizes[near])[:-1]]
            both = np.add.reduceat(inside[np.concatenate([sets[b] for b in near.tolist()])], cuts)
            inside[sets[at]] = 0
            enough = 100 * both >= percent * (sizes[at] + sizes[near] - both)
            for b in near[enough].tolist():
                if label[b] != label[at]:
                    hits.append((min(docs[at], docs[b]), max(docs[at], docs[b])))
                    label[label == label[b]] = label[at]
        return pa.table({n: pa.array([x[k] for x in hits], pa.int64()) for k, n in enumerate("ab")})

    return texts.groupBy("key", "block", "part").applyInArrow(linked, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Words are runs of bytes other than ASCII white space, with A-Z in lower case. Texts
    are linked if 100 * shared shingles >= ``percent`` * all shingles of the two. The
    component is the smallest id that links lead to; kept marks the row with that id.

    With 32 bands of 5 rows two texts at 0.8 share no bucket once in 300,000 cases, at
    0.9 never in practice. ``percent`` below 70 needs other bands.

    Null or empty text: no shingles, its own component, never linked, even to its like.
    Ids must be integers and not null; rows with an id that occurs again belong together,
    and all are kept if that id is kept. An empty table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    sketch = stored(sketches(source, shingle, bands, rows), "sketches")
    full = sketch.where("n_shingles > 0")
    classes = stored(full.groupBy("digest").agg(F.min("doc").alias("a")), "classes")
    copies = spread_join(full.select("doc", "digest"), classes, ["digest"], "inner")
    copies = stored(copies.select(F.col("doc").alias("u"), F.col("a").alias("v")), "copies")

    leaders_only = classes.select(F.col("a").alias("doc"))
    keyed = full.join(leaders_only, "doc", "left_semi")
    keyed = keyed.select("doc", "n_shingles", F.posexplode("keys").alias("band", "key"))
    buckets = keyed.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("z"))
    buckets = buckets.where("a < z").select("key", "a")
    shared = stored(spread_join(keyed, buckets, ["key"], "inner"), "buckets")
    stars = shared.where("a < doc")

    first = stars.groupBy("doc").agg(F.min("a").alias("a")).select("a", F.col("doc").alias("b"))
    first = stored(first, "first")
    links = stored(confirmed(first, source, shingle, percent), "links")
    parent = links.select(F.col("b").alias("doc"), F.col("a").alias("up"))
    upper = parent.select(F.col("doc").alias("up"), F.col("up").alias("top"))
    parent = parent.join(broadcast_if_small(upper), "up", "left")
    parent = stored(parent.select("doc", F.coalesce("top", "up").alias("top")), "parents")

    def topped(df, name):
        side = broadcast_if_small(parent.select(F.col("doc").alias(name), F.col("top").alias("_t")))
        return df.join(side, name, "left").withColumn("top_" + name, F.coalesce("_t", name)).drop("_t")

    stars = stars.select("a", F.col("doc").alias("b")).distinct()
    apart = topped(topped(stars, "a"), "b").where("top_a <> top_b").select("a", "b")
    apart = stored(apart.join(first, ["a", "b"], "left_anti"), "apart")
    links = links.unionAll(stored(confirmed(apart, source, shingle, percent), "links"))
    found = stored(components(links.toDF("v", "u")), "components")

    labelled = shared.where("a < doc").join(
        broadcast_if_small(found.select(F.col("node").alias("doc"), "component")), "doc", "left"
    )
    labelled = labelled.select(
        "key", "band", "doc", "n_shingles", F.coalesce("component", "doc").alias("component")
    )
    share = percent / 100
    count = bands * rows
    least_equal = int(count * share - 4 * (count * share * (1 - share)) ** 0.5)
    labelled = stored(labelled, "labelled")
    checks = {"shingle": shingle, "percent": percent, "bands": bands, "least_equal": least_equal}
    more = _rest_links(labelled, full, source, **checks)
    more = stored(more, "links")
    if not more.isEmpty():
        found = stored(components(links.unionAll(more).toDF("v", "u")), "components")

    top = found.select(F.col("node").alias("v"), "component")
    joined = copies.join(broadcast_if_small(top), "v", "left")
    joined = joined.groupBy(F.col("u").alias("doc")).agg(
        F.min(F.coalesce("component", "v")).alias("component")
    )
    result = spread_join(sketch.select("doc", "n_shingles"), joined, ["doc"], "left")
    label = F.coalesce("component", "doc")
    return result.select(
        F.col("doc").alias(id_column),
        "n_shingles",
        label.alias("component_id"),
        (label == F.col("doc")).alias("kept"),
    )
