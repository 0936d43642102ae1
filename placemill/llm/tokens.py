"""Token ids of whole texts, as the library gives them, and a digest cache of counts."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.llm import words as W
from placemill.llm.shared import free_name, stored, worker_memory
from placemill.operators.keyfilter import MAX_KEYS, maybe_among
from placemill.operators.spread import spread_join
from placemill.runtime import broadcast_if_small

#: Words that a worker remembers before it starts again, and the bytes of text at a time.
REMEMBERED = 1_500_000
_BATCH = 2 << 20
_GROUP = 64
#: Words that the library encodes at a time; its results are many times as large as ids.
_LEARNED = 4096
_TWO_BYTES = 0x800  # code points of one or two bytes in UTF-8

Encode = Callable[[pa.Array], list]


def tokenizer_digest(path: str) -> str:
    """Digest of a tokenizer: its file and the version of the library that reads it."""
    name = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"\n{name} {version(name)}".encode()).hexdigest()


class WordEnds:
    """Ids by a ``.json`` tokenizer that drops white space, word by word.

    White space only ever separates: the ids of a text are those of its words, one after
    the other. So each word is encoded once and remembered under its 64-bit code. A full
    stop or comma is a word of its own after the letters where the tokenizer's own
    normaliser and pre-tokenizer make it a piece of its own (not after U+0130, which becomes a
    letter and a mark, and the mark stays with the point). ASCII words
    are put in lower case, as the tokenizer does it, except those with ``<``: special
    strings are looked for before that. Words of letters alone are encoded in groups and
    parted at the pieces that end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[at for piece, at in vocabulary.items() if piece.endswith("</w>")]] = True
        self.parts = np.array([self._parts_from(chr(at)) for at in range(_TWO_BYTES)], bool)
        self._forget()

    def _parts_from(self, letter: str) -> bool:
        """Whether points after the letter are always pieces of their own."""
        if not letter.isalpha():
            return False
        clean, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        for point in ".,":
            pieces = cut.pre_tokenize_str(clean.normalize_str(f"a{letter}{point}"))
            if len(pieces) < 2 or pieces[-1][0] != point:
                return False
        return True

    def _forget(self) -> None:
        self.codes = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")

    def _plain(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of words, on end, and how many each word has."""
        rows = self.tokenizer.encode_batch(words, add_special_tokens=False)
        found = [row.ids for row in rows]
        return [np.array([at for ids in found for at in ids], "<u4")], [
            np.array([len(ids) for ids in found], np.int64)
        ]

    def _letters(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The same of words of letters alone, each of which ends in an end piece."""
        groups = [words[at : at + _GROUP] for at in range(0, len(words), _GROUP)]
        joined = [" ".join(group) for group in groups]
        rows = self.tokenizer.encode_batch(joined, add_special_tokens=False)
        out: tuple[list[np.ndarray], list[np.ndarray]] = [], []
        for group, row in zip(groups, rows, strict=True):
            ids = np.array(row.ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(group) and cut[-1] == len(ids):
                found = [ids], [np.diff(cut, prepend=0)]
            else:
                found = self._plain(group)
            for one, more in zip(out, found, strict=True):
                one += more
        return out

    def _learn(self, codes: np.ndarray, words: list[str]) -> None:
        """Remembers the ids of unknown words; ``codes`` are in order."""
        letter = np.array([word.isalpha() for word in words], bool)
        sizes, begins = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        found, held = [self.ids], len(self.ids)
        for chosen, encode in ((letter, self._letters), (~letter, self._plain)):
            at = np.flatnonzero(chosen)
            for some in np.split(at, np.arange(_LEARNED, len(at), _LEARNED)):
                if len(some):
                    ids, many = encode([words[one] for one in some.tolist()])
                    found += ids
                    sizes[some] = np.concatenate(many)
                    begins[some] = held + np.cumsum(sizes[some]) - sizes[some]
                    held += int(sizes[some].sum())
        self.ids = np.concatenate(found)
        place = np.searchsorted(self.codes, codes)
        self.codes = np.insert(self.codes, place, codes)
        self.begins = np.insert(self.begins, place, begins)
        self.sizes = np.insert(self.sizes, place, sizes)

    def _words(self, column: pa.Array):
        """Folded bytes, spans of words with their points apart, and each text's first."""
        data, offsets = W.text_bytes(column)
        starts, ends = W.spans(data, offsets)
        if not len(starts):
            return data, starts, ends, np.zeros(len(offsets), np.int64)
        odd = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data >= 128) | (data == ord("<")), out=odd[1:])
        fold = np.zeros(len(data), bool)
        spaces = (data == 32) | ((data >= 9) & (data <= 13))
        fold[~spaces] = np.repeat(odd[ends] == odd[starts], ends - starts)
        data = np.where(fold, W.lower_ascii(data), data)
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)].astype(np.int64)
        earlier = data[np.maximum(ends - 3, 0)].astype(np.int64)
        size = ends - starts
        wide = (size > 2) & (earlier >= 0xC2) & (earlier <= 0xDF) & (before >= 0x80)
        letter = np.where(wide, (earlier & 0x1F) << 6 | before & 0x3F, before)
        point = ((last == ord(".")) | (last == ord(","))) & (size > 1)
        point &= (wide | (before < 0x80)) & self.parts[letter]
        at = np.flatnonzero(point)
        first = np.searchsorted(starts, offsets)
        first = first + np.searchsorted(at, first)
        starts = np.insert(starts, at + 1, ends[at] - 1)
        cut = ends - point
        return data, starts, np.insert(cut, at + 1, ends[at]), first

    def __call__(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an Arrow column, little-endian; null counts as empty."""
        out: list[np.ndarray] = []
        for begin, end in W.pieces(column, _BATCH):
            if len(self.codes) > REMEMBERED:
                self._forget()
            data, starts, ends, first = self._words(column.slice(begin, end - begin))
            codes, here, back = np.unique(
                W.codes_of(data, starts, ends), return_index=True, return_inverse=True
            )
            near = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
            new = self.codes[near] != codes if len(self.codes) else np.ones(len(codes), bool)
            if new.any():
                raw = data.tobytes()
                cuts = zip(starts[here[new]].tolist(), ends[here[new]].tolist(), strict=True)
                self._learn(codes[new], [raw[a:b].decode() for a, b in cuts])
            near = np.searchsorted(self.codes, codes)[back]
            sizes, begins = self.sizes[near], self.begins[near]
            total = np.r_[0, np.cumsum(sizes)]
            place = np.arange(total[-1]) + np.repeat(begins - total[:-1], sizes)
            out += np.split(self.ids[place], total[first[1:-1]])
        return out


class Pieces:
    """Ids by a sentencepiece model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)

    def __call__(self, column: pa.Array) -> list[np.ndarray]:
        texts = [text or "" for text in column.to_pylist()]
        return [np.array(row, "<u4") for row in self.model.encode(texts, num_threads=1)]


class Plain:
    """Ids by any ``.json`` tokenizer, text by text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def __call__(self, column: pa.Array) -> list[np.ndarray]:
        texts = [text or "" for text in column.to_pylist()]
        rows = (self.tokenizer.encode(text, add_special_tokens=False) for text in texts)
        return [np.array(row.ids, "<u4") for row in rows]


def drops_space(path: str) -> bool:
    """Whether a tokenizer maps white space to one space, then splits words from it.

    True for word-end vocabularies whose pre-tokenizer keeps only what is not space.
    """
    if path.endswith(".model"):
        return False
    import json

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return (
        [step["type"] for step in steps] == ["NFC", "Replace", "Lowercase"]
        and spec["model"].get("end_of_word_suffix") == "</w>"
        and splits[0].get("type") == "Split"
        and splits[0].get("invert") is True
        and splits[0].get("behavior") == "Removed"
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )


def encoder(path: str) -> Encode:
    """The encoder for a tokenizer file, kept by the worker."""
    memory = worker_memory()
    if path not in memory:
        kind = Pieces if path.endswith(".model") else WordEnds if drops_space(path) else Plain
        memory[path] = kind(path)
    return memory[path]


_CACHE = "tokenizer string, digest string, n_tokens long"


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts, one row for each tokenizer and digest; none if not yet made."""
    if not _exists(spark, path):
        return spark.createDataFrame([], _CACHE)
    rows = spark.read.schema(_CACHE).parquet(path)
    return rows.groupBy("tokenizer", "digest").agg(F.max("n_tokens").alias("n_tokens"))


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise
    return True


def normal_text(text_column: str, path: str):
    """The content that a count belongs to: exact text, or less where space counts nothing."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return F.regexp_replace(text, "[ \t\r\n]+", " ") if drops_space(path) else text


def _filled(docs: DataFrame, tokenizer: str, cache: str, id_column: str, text_column: str):
    """Encodes the misses into the cache; the rows without texts, and all counts by digest."""
    version_of = tokenizer_digest(tokenizer)
    n_bytes, digest = free_name(docs, "n_bytes"), free_name(docs, "digest")
    content = F.sha2(normal_text(text_column, tokenizer), 256)
    size = F.octet_length(F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    rest = [F.col(name) for name in docs.columns if name != text_column]
    keyed = docs.select(*rest, size.cast("long").alias(n_bytes), content.alias(digest))
    keyed = stored(keyed, "digests")
    known = read_cache(docs.sparkSession, cache).where(F.col("tokenizer") == version_of)
    one = keyed.groupBy(F.col(digest).alias("digest")).agg(F.min(id_column).alias("id"))
    misses = one.join(known.select("digest"), "digest", "left_anti")
    misses = stored(misses.withColumn("row_key", F.xxhash64("id", "digest")), "misses")
    texts = docs.select(
        F.col(id_column).alias("id"), content.alias("digest"), F.col(text_column).alias("text")
    ).withColumn("row_key", F.xxhash64("id", "digest"))
    missing = misses.count()
    if missing <= MAX_KEYS:
        wanted = maybe_among(texts, misses, ["row_key"], keys=missing)
    else:
        wanted = texts.join(misses.select("row_key"), "row_key", "left_semi")

    def run(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            for begin, end in W.pieces(batch.column(1)):
                part = batch.slice(begin, end - begin)
                sizes = [len(ids) for ids in encode(part.column(1))]
                yield pa.record_batch(
                    [part.column(0), pa.array(sizes, pa.int64())], ["digest", "n_tokens"]
                )

    fresh = wanted.select("digest", "text").mapInArrow(run, "digest string, n_tokens long")
    fresh = fresh.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    fresh = spread_join(fresh, misses.select("digest"), ["digest"], "left_semi")
    fresh.select(F.lit(version_of).alias("tokenizer"), "digest", "n_tokens").write.mode(
        "append"
    ).parquet(cache)
    counts = read_cache(docs.sparkSession, cache).where(F.col("tokenizer") == version_of)
    n_tokens = free_name(docs, "n_tokens")
    counts = counts.select(F.col("digest").alias(digest), F.col("n_tokens").alias(n_tokens))
    return keyed, content, counts, digest


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` without the text, with ``n_bytes`` and ``n_tokens`` (long) from the cache folder.

    Content is normalised (white space runs become a space, for tokenizers that drop
    white space), digested, and joined to the counts stored for the digest and the
    tokenizer's version. Of the digests without a count one text each is encoded, whole,
    where it lies, and the counts are appended. Texts are never shuffled: a bitmap of the
    misses' hashes finds them in the scan, and the few texts that share a bit without being
    one are encoded for nothing. Beyond ``MAX_KEYS`` misses the bitmap would hold nothing
    back, and the texts of the misses are joined by a hash of id and digest instead.

    Two runs that append at once store the same counts twice, which is harmless. Null
    text counts as empty, with no tokens. Null and repeated ids are fine. No rows give no
    rows and an unchanged cache. Underscores go in front of a result's name that ``docs``
    has. ``tokenizer`` is a path that all executors have.
    """
    keyed, _, counts, digest = _filled(docs, tokenizer, cache, id_column, text_column)
    return spread_join(keyed, counts, [digest], "left").drop(digest)


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``n_tokens`` (long), by the cache of :func:`token_counts`.

    Rows keep their texts, so the join that attaches the counts moves them, unless the counts are
    few. Where the texts are not needed, take :func:`token_counts`. Odd rows as there.
    """
    _, content, counts, digest = _filled(docs, tokenizer, cache, id_column, text_column)
    counts = broadcast_if_small(counts)
    return spread_join(docs.withColumn(digest, content), counts, [digest], "left").drop(digest)
