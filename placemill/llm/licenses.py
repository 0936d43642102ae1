"""Licence scan: winnowed fingerprints find candidates, banded alignment confirms them."""

from __future__ import annotations

from bisect import bisect
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemill.llm import words as W
from placemill.llm.shared import free_name

GRAM = 3
WINDOW = 4


def winnowed(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the least gram of every ``window`` consecutive ones, the last if equal."""
    if not len(grams):
        return np.zeros(0, np.int64)
    size = min(window, len(grams))
    shown = np.lib.stride_tricks.sliding_window_view(grams, size)[:, ::-1]
    return np.unique(np.arange(len(shown)) + size - 1 - shown.argmin(axis=1))


@dataclass
class TemplateIndex:
    """Inverted index: sorted fingerprints with the template and position of each."""

    names: list[str]
    codes: list[np.ndarray]
    prints: np.ndarray
    template: np.ndarray
    position: np.ndarray
    sizes: list[int]


def sure_run(count: int, least: float) -> int:
    """Consecutive words that stay of ``count`` when as many are changed as ``least`` allows."""
    changed = int(count * (1 - least) + 1e-9)
    return -(-(count - changed) // (changed + 1))


def build_index(templates: Mapping[str, str], least: float = 0.8) -> TemplateIndex:
    """The index of the templates; its size is that of the templates, not of the data.

    A template is winnowed if a run of words as long as winnowing needs always stays at the
    coverage ``least``. Of others all grams are kept, no longer than the run that stays.
    """
    names = sorted(templates)
    column = pa.array([templates[name] for name in names], pa.string())
    found = W.words_of(column, lower=True, inside_of=W.letter_or_digit)
    codes = [found.codes[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    rows, sizes = [], set()
    for at, own in enumerate(codes):
        if len(own) < GRAM:
            continue
        stays = sure_run(len(own), least)
        size = max(1, min(GRAM, stays))
        grams = W.runs(own, size)
        chosen = winnowed(grams) if stays >= GRAM + WINDOW - 1 else range(len(grams))
        rows += [(int(grams[p]), at, int(p)) for p in chosen]
        sizes.add(size)
    rows.sort()
    return TemplateIndex(
        names,
        codes,
        np.array([row[0] for row in rows], np.uint64),
        np.array([row[1] for row in rows], np.int64),
        np.array([row[2] for row in rows], np.int64),
        sorted(sizes),
    )


def banded_alignment(
    template: np.ndarray, text: np.ndarray, shift: int, band: int
) -> tuple[int, int, int]:
    """Most template words found in order in ``text``, and the first and last of them.

    Word i of the template may meet words ``i + shift - band`` to ``i + shift + band``.
    Returns (matched, first, last) with positions in ``text``; (0, 0, 0) for none. Of
    equal alignments, the one with the shortest span counts.
    """
    width = 2 * band + 1
    score, begin, end = [0] * (width + 1), [0] * (width + 1), [0] * (width + 1)
    for i in range(len(template)):
        new, new_begin, new_end = [0] * (width + 1), [0] * (width + 1), [0] * (width + 1)
        for k in range(width):
            j = i + shift - band + k
            best = (score[k + 1], begin[k + 1] - end[k + 1], begin[k + 1], end[k + 1])
            if k:
                best = max(best, (new[k - 1], new_begin[k - 1] - new_end[k - 1], new_begin[k - 1], new_end[k - 1]))
            if 0 <= j < len(text) and text[j] == template[i]:
                first = begin[k] if score[k] else j
                best = max(best, (score[k] + 1, first - j, first, j))
            new[k], _, new_begin[k], new_end[k] = best
        score, begin, end = new, new_begin, new_end
    top = max(range(width), key=lambda k: (score[k], begin[k] - end[k]))
    return score[top], begin[top], end[top]


def _clusters(places: np.ndarray, shifts: np.ndarray, reach: int):
    """Groups of hits of one template whose shifts are near each other."""
    order = np.argsort(shifts, kind="stable")
    cut = np.flatnonzero(np.diff(shifts[order]) > reach) + 1
    return np.split(order, cut)


def scan_words(codes: np.ndarray, index: TemplateIndex, least: float) -> list[tuple]:
    """(template, coverage, matched, first word, last word) for one text."""
    places, entries = [], []
    for size in index.sizes:
        grams = W.runs(codes, size)
        begin = np.searchsorted(index.prints, grams, "left")
        count = np.searchsorted(index.prints, grams, "right") - begin
        at = np.flatnonzero(count)
        place = np.repeat(at, count[at])
        inner = np.arange(len(place)) - np.repeat(np.cumsum(count[at]) - count[at], count[at])
        places.append(place)
        entries.append(np.repeat(begin[at], count[at]) + inner)
    if not sum(map(len, places)):
        return []
    return _aligned(codes, index, np.concatenate(places), np.concatenate(entries), least)


def _aligned(codes, index, place, entry, least) -> list[tuple]:
    found = []
    template, shift = index.template[entry], place - index.position[entry]
    for one in np.unique(template).tolist():
        mine = np.flatnonzero(template == one)
        own = index.codes[one]
        band = max(2, len(own) // 8)
        spans = []
        for cluster in _clusters(place[mine], shift[mine], band):
            spans += _spans(codes, own, place[mine][cluster], shift[mine][cluster], band, least)
        taken: list[tuple[int, int]] = []
        for matched, first, last in sorted(set(spans), key=lambda s: (-s[0], s[2] - s[1], s[1])):
            after = bisect(taken, (first, last))
            if (not after or taken[after - 1][1] < first) and (
                after == len(taken) or last < taken[after][0]
            ):
                taken.insert(after, (first, last))
                found.append((one, matched / len(own), matched, first, last))
    return found


def _spans(codes, own, place, shift, band: int, least: float) -> list[tuple]:
    """(matched, first, last) at every shift of a chain that no better one explains."""
    spans, tried = [], set()
    order = np.argsort(shift, kind="stable")
    place, shift = place[order], shift[order]
    open_hits = np.ones(len(place), bool)
    values, begin, hits = np.unique(shift, return_index=True, return_counts=True)
    peaks = [(int(values[at]), int(begin[at]), int(hits[at])) for at in np.argsort(-hits, kind="stable")]
    for peak, at, count in [(int(np.median(shift)), 0, len(shift)), *peaks]:
        if not open_hits[at : at + count].any():
            continue
        within = np.searchsorted(shift, [peak - band, peak + band + 1])
        near = int(np.median(shift[within[0] : within[1]])) if within[0] < within[1] else peak
        for middle in {peak, near} - tried:
            tried.add(middle)
            low = max(0, middle - band)
            words = codes[low : max(0, middle + len(own) + band)]
            if np.isin(own, words).sum() < least * len(own):
                continue
            matched, first, last = banded_alignment(own, words, middle - low, band)
            if matched >= least * len(own):
                spans.append((matched, first + low, last + low))
                open_hits &= (place < first + low) | (place > last + low)
    return spans


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str],
    *,
    least: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each place where a text holds a template.

    Columns: the id, ``template``, ``coverage`` (matched words of the template, 0 to 1),
    ``matched`` (words), and the span ``begin`` to ``end`` in characters, end exclusive.
    Words are runs of letters and digits, A-Z in lower case. A template needs three words.
    Only spans with a coverage of ``least`` or more are returned; a template inside a longer
    one is returned besides it, and a repeated notice once for each place.

    Null and empty texts and texts without a notice give no rows; equal rows each give
    their own. No shuffle: the index, as large as the templates, is sent to the tasks.
    """
    index = build_index(templates, least)
    kind = docs.schema[id_column].dataType.simpleString()
    name = free_name(docs.select(id_column), "template")

    def run(batches):
        for batch in batches:
            for begin, end in W.pieces(batch.column(1)):
                part = batch.slice(begin, end - begin)
                found = W.words_of(part.column(1), lower=True, inside_of=W.letter_or_digit)
                yield _scanned(part.column(0), found, index, least, id_column, name)

    schema = f"`{id_column}` {kind}, `{name}` string, coverage double, matched long, begin long, end long"
    return docs.select(F.col(id_column), F.col(text_column)).mapInArrow(run, schema)


def _scanned(ids, found: W.Words, index, least, id_column, name) -> pa.RecordBatch:
    rows = []
    if len(index.prints):
        hits = [np.zeros(0, np.int64)]
        for size in index.sizes:
            grams = W.runs(found.codes, size)
            near = np.minimum(np.searchsorted(index.prints, grams), len(index.prints) - 1)
            hits.append(np.flatnonzero(index.prints[near] == grams))
        hits = np.concatenate(hits)
        for row in np.unique(np.searchsorted(found.first, hits, side="right") - 1).tolist():
            a, b = found.first[row], found.first[row + 1]
            starts, ends = found.starts[a:b], found.ends[a:b]
            chars = np.cumsum((found.data[found.offsets[row] : found.offsets[row + 1]] & 0xC0) != 0x80)
            for one, share, matched, first, last in scan_words(found.codes[a:b], index, least):
                begin = int(chars[starts[first] - found.offsets[row]]) - 1
                end = int(chars[ends[last] - 1 - found.offsets[row]])
                rows.append((row, index.names[one], share, matched, begin, end))
    columns = [ids.take(pa.array([row[0] for row in rows], pa.int64()))]
    kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
    columns += [pa.array([row[at + 1] for row in rows], kind) for at, kind in enumerate(kinds)]
    return pa.record_batch(columns, [id_column, name, "coverage", "matched", "begin", "end"])
