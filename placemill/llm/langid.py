"""Language identification: known words first, then shorter and shorter n-grams.

Training counts all words of a bounded sample of labelled documents per language, and
the character n-grams of those words, all as grouped sums on Spark. A word is a letter and the
letters and marks after it, by Unicode category. A word that training
saw scores by its log frequency in each language. An unseen word scores by the mean over
its known n-grams of the longest length that has any. The scores of all words of a text
add up; their softmax gives the language and its probability.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemill.llm import words as W
from placemill.llm.shared import free_name, free_worker, give_back, stored

UNKNOWN = "und"
#: Bound of the sample of labelled documents a language; all words of the sample count.
DOCS_PER_LANGUAGE = 4000
#: Bounds of the commonest words and n-grams of each length a language; None keeps all.
WORDS_PER_LANGUAGE: int | None = None
GRAMS_PER_LANGUAGE: int | None = None
LONGEST_GRAM = 4
#: Words, and n-grams of each length, longest first.
_KINDS = ("w", *(str(size) for size in range(LONGEST_GRAM, 0, -1)))
_SMOOTH = 0.5
_TEXT_BYTES = 1 << 20
_ITEM_BYTES = 1 << 18
_LETTER, _MARK = 1, 2
_COUNTS = pa.schema([("item", pa.string()), ("lang", pa.string()), ("n", pa.int64())])


def character_classes() -> np.ndarray:
    """For each code point whether it is a letter (Unicode L) or a mark (Unicode M)."""
    first = (unicodedata.category(chr(at))[0] for at in range(sys.maxunicode + 1))
    kinds = {"L": _LETTER, "M": _MARK}
    return np.fromiter((kinds.get(kind, 0) for kind in first), np.uint8, sys.maxunicode + 1)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts on end, and where each begins."""
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return data, np.r_[0, np.cumsum([len(text) for text in texts], dtype=np.int64)]


def _word_spans(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray):
    """Where words begin and end: a letter, then letters and marks, in one text."""
    kind = classes[data]
    starts, ends = W.spans(data, offsets, lambda points: kind > 0)
    # A run that begins with marks begins at its first letter, if it has one.
    place = np.r_[np.flatnonzero(kind == _LETTER), len(data)]
    starts = place[np.searchsorted(place, starts)]
    return starts[starts < ends], ends[starts < ends]


def words_in(text: str | None) -> list[str]:
    """The words of a text in lower case."""
    low = (text or "").lower()
    spans = _word_spans(*_points([low]), character_classes())
    return [low[a:b] for a, b in zip(*(side.tolist() for side in spans), strict=True)]


def grams_of(word: str, size: int) -> list[str]:
    """Character n-grams of a word with its ends marked; single letters without."""
    marked = word if size == 1 else f"<{word}>"
    return [marked[at : at + size] for at in range(len(marked) - size + 1)]


def _codes(items: pa.Array) -> np.ndarray:
    """The code of each item's code points; some of the strings exist at a time."""
    out = [np.zeros(0, np.uint64)]
    for begin, end in W.pieces(items, _ITEM_BYTES):
        data, offsets = _points(items.slice(begin, end - begin).to_pylist())
        out.append(W.codes_of(data, offsets[:-1], offsets[1:]))
    return np.concatenate(out)


@dataclass
class Scores:
    """Sorted 64-bit codes of items, and the log frequencies of each in all languages."""

    codes: np.ndarray
    table: np.ndarray

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The row of each code, or -1."""
        if not len(self.codes):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, at, -1)


class Scorer:
    """A model as arrays: the words, and the n-grams of each length, longest first."""

    def __init__(self, languages: list[str], items: dict[str, pa.Array], table: np.ndarray):
        self.languages, self.classes = languages, character_classes()
        self.items: dict[str, Scores] = {}
        begin = 0
        for kind, found in items.items():
            codes = _codes(found)
            order = np.argsort(codes)
            self.items[kind] = Scores(codes[order], table[begin : begin + len(found)][order])
            begin += len(found)

    def _backed_off(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Scores of unseen words: the mean over the longest known n-grams, else nothing."""
        sizes = ends - starts + 2
        first = np.cumsum(sizes) - sizes
        marked = np.full(int(sizes.sum()), ord(">"), np.uint32)
        marked[first] = ord("<")
        inside = np.arange(len(marked)) - np.repeat(first, sizes)
        body = (inside > 0) & (inside < np.repeat(sizes - 1, sizes))
        marked[body] = data[np.repeat(starts - 1, sizes)[body] + inside[body]]
        out = np.zeros((len(starts), len(self.languages)))
        left = np.arange(len(starts))
        for size in range(LONGEST_GRAM, 0, -1):
            ends_of = sizes[left] - (2 if size == 1 else 0)
            count = np.maximum(ends_of - size + 1, 0)
            owner = np.repeat(np.arange(len(left)), count)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            at += first[left][owner] + (1 if size == 1 else 0)
            row = self.items[str(size)].find(W.codes_of(marked, at, at + size))
            owner, row = owner[row >= 0], row[row >= 0]
            known = np.bincount(owner, minlength=len(left))
            table = self.items[str(size)].table
            for lang in range(len(self.languages)):
                sums = np.bincount(owner, table[row, lang], len(left))
                out[left, lang] = np.where(known > 0, sums / np.maximum(known, 1), 0.0)
            left = left[known == 0]
            if not len(left):
                break
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its probability."""
        low = [(text or "").lower() for text in texts]
        data, offsets = _points(low)
        starts, ends = _word_spans(data, offsets, self.classes)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        if not len(starts) or not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        codes = W.codes_of(data, starts, ends)
        _, here, back = np.unique(codes, return_index=True, return_inverse=True)
        row = self.items["w"].find(codes[here])
        scores = np.zeros((len(here), len(self.languages)))
        scores[row >= 0] = self.items["w"].table[row[row >= 0]]
        unseen = here[row < 0]
        scores[row < 0] = self._backed_off(data, starts[unseen], ends[unseen])
        total = np.stack(
            [np.bincount(owner, scores[back, at], len(texts)) for at in range(len(self.languages))], 1
        )
        odds = np.exp(total - total.max(axis=1, keepdims=True))
        best = odds.argmax(axis=1)
        score = odds[np.arange(len(texts)), best] / odds.sum(axis=1)
        none = np.bincount(owner, minlength=len(texts)) == 0
        score[none] = 0.0
        return [UNKNOWN if no else self.languages[at] for at, no in zip(best, none, strict=True)], score


@dataclass
class LanguageModel:
    """Log frequencies per language, a row of ``table`` for each word and n-gram.

    ``items`` has them by kind, in the order of the rows, as Arrow arrays: a Python string
    for each takes many times its letters.
    """

    languages: list[str]
    items: dict[str, pa.Array]
    table: np.ndarray

    @cached_property
    def rows(self) -> dict[str, int]:
        """The row of each item, its kind in front: to look into a small model."""
        names = (kind + item for kind, own in self.items.items() for item in own.to_pylist())
        return {name: at for at, name in enumerate(names)}

    def scorer(self) -> Scorer:
        return Scorer(self.languages, self.items, self.table)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its probability; ``und`` and 0 without a letter or a model."""
        languages, scores = self.scorer().predict([text])
        return languages[0], float(scores[0])


def _word_counts(classes: np.ndarray):
    """Counts the words of batches (language, text), chunk by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker()
        for batch in batches:
            for begin, end in W.pieces(batch.column(1), _TEXT_BYTES):
                part = batch.slice(begin, end - begin)
                low = [(text or "").lower() for text in part.column(1).to_pylist()]
                data, offsets = _points(low)
                starts, ends = _word_spans(data, offsets, classes)
                owner = np.searchsorted(offsets, starts, side="right") - 1
                whole = "".join(low)
                words = [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                langs = part.column(0).take(pa.array(owner))
                found = pa.table({"lang": langs, "word": pa.array(words, pa.string())})
                counts = found.group_by(["lang", "word"]).aggregate([([], "count_all")])
                yield from counts.rename_columns(["lang", "word", "n"]).to_batches()
            give_back()

    return run


def train(
    labelled: DataFrame,
    *,
    text_column: str = "text",
    lang_column: str = "lang",
    id_column: str = "doc_id",
    docs_per_language: int = DOCS_PER_LANGUAGE,
) -> LanguageModel:
    """A model from the rows of ``labelled`` that have text and a language.

    A language with more than ``docs_per_language`` rows is sampled by a hash of the id
    down to about that many. Rows without text or language, and the language ``und``, are
    left out. No rows: a model without languages, which predicts ``und``.
    """
    rows = labelled.select(
        F.col(id_column).alias("id"), F.col(lang_column).alias("lang"), F.col(text_column).alias("text")
    ).where(f"lang is not null and text is not null and lang <> '{UNKNOWN}'")
    found = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not found:
        return _model({kind: (_COUNTS.empty_table(), {}) for kind in _KINDS})
    shares = {lang: min(1.0, docs_per_language / n) for lang, n in found.items()}
    table = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    draw = F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.where(draw < table[F.col("lang")]).select("lang", "text")
    words = chosen.mapInArrow(_word_counts(character_classes()), "lang string, word string, n long")
    words = stored(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    counts = {"w": _commonest(words.withColumnRenamed("word", "item"), WORDS_PER_LANGUAGE)}
    for size in map(int, _KINDS[1:]):
        marked = F.col("word") if size == 1 else F.concat(F.lit("<"), "word", F.lit(">"))
        begin = F.explode(F.sequence(F.lit(1), F.length("marked") - size + 1)).alias("at")
        grams = words.select("lang", "n", marked.alias("marked"))
        grams = grams.where(F.length("marked") >= size).select("lang", "n", "marked", begin)
        grams = grams.withColumn("item", F.substring("marked", F.col("at"), F.lit(size)))
        grams = grams.groupBy("lang", "item").agg(F.sum("n").alias("n"))
        counts[str(size)] = _commonest(grams, GRAMS_PER_LANGUAGE)
    model = _model(counts)
    del counts
    give_back()
    return model


def _commonest(counts: DataFrame, most: int | None) -> tuple[pa.Table, dict[str, int]]:
    """(item, lang, n) of the sample's counts, and the total of each language.

    With ``most``, only items that are among so many commonest of a language; such an
    item keeps its counts in all languages.
    """
    table = counts.select("item", "lang", "n").toArrow().cast(_COUNTS)
    totals = table.group_by("lang").aggregate([("n", "sum")])
    total = dict(zip(*(totals.column(name).to_pylist() for name in ("lang", "n_sum")), strict=True))
    if most is not None:
        keep = []
        for lang in total:
            own = table.filter(pc.equal(table.column("lang"), lang))
            own = own.sort_by([("n", "descending"), ("item", "ascending")])
            keep += own.column("item").slice(0, most).chunks
        kept = pa.chunked_array(keep, pa.string())
        table = table.filter(pc.is_in(table.column("item"), value_set=kept))
    return table, total


def _model(counts: dict[str, tuple[pa.Table, dict[str, int]]]) -> LanguageModel:
    """The model of the counts of each kind: sums and logarithms of whole columns."""
    languages = sorted(set().union(*(table["lang"].unique().to_pylist() for table, _ in counts.values())))
    items, parts = {}, []
    for kind, (table, total) in counts.items():
        coded = table["item"].combine_chunks().dictionary_encode()
        lang = pc.index_in(table["lang"], value_set=pa.array(languages, pa.string())).to_numpy()
        part = np.full((len(coded.dictionary), len(languages)), _SMOOTH)
        part[coded.indices.to_numpy(), lang] += table["n"].to_numpy()
        part /= np.array([total.get(name, 1) for name in languages]) + _SMOOTH * 1000
        items[kind] = coded.dictionary
        parts.append(np.log(part, out=part))
    return LanguageModel(languages, items, np.concatenate(parts))


def predicted(model: LanguageModel, docs: DataFrame, text: Column) -> Column:
    """Struct column (lang, score) for a text column; the model travels by broadcast.

    It is arrays of codes and scores, bounded by the sample that it was trained on. The
    driver's copy of them goes once it is sent.
    """
    held = docs.sparkSession.sparkContext.broadcast(model.scorer())
    give_back()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        free_worker()
        own = held.value
        for column in batches:
            langs, scores = [], [np.zeros(0)]
            for begin, end in W.pieces(column, _TEXT_BYTES):
                found = own.predict(column.slice(begin, end - begin).to_pylist())
                langs += found[0]
                scores.append(found[1])
            parts = [pa.array(langs, pa.string()), pa.array(np.concatenate(scores))]
            yield pa.StructArray.from_arrays(parts, ["lang", "score"])
            give_back()

    return F.arrow_udf(run, "lang string, score double")(text)


def identify(
    docs: DataFrame,
    model: LanguageModel,
    *,
    text_column: str = "text",
    out: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` with the language of each whole text and its probability.

    Null text and text without a letter: ``und``, 0.0. Ties: the first language by name.
    Every row and column stays; underscores go in front of a name that is taken.
    """
    names = [free_name(docs, name) for name in out]
    both = free_name(docs, "langid")
    done = docs.withColumn(both, predicted(model, docs, F.col(text_column)))
    for name, part in zip(names, ("lang", "score"), strict=True):
        done = done.withColumn(name, F.col(both)[part])
    return done.drop(both)


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))
