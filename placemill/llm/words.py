"""Words of Arrow text columns as numpy arrays of spans and 64-bit codes.

A word is a longest run of bytes other than space and 0x09 to 0x0D. Its code is a
polynomial over its bytes, modulo 2**64, with a final mix. All functions take the
words of many texts at once, one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LEAST = np.uint64(0)
MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass
class Words:
    """Words of ``len(first) - 1`` texts; those of text i are ``first[i]:first[i+1]``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    codes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, at: int) -> bytes:
        return self.data[self.offsets[at] : self.offsets[at + 1]].tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, kept for the next call.

    They are made anew where they are needed: a function that is sent to the workers
    takes none of the numbers with it.
    """

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def first(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = max(count, CHUNK_BYTES + 1)
            up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
            up[1:] = np.uint64(_BASE)
            down[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


_POWERS = _Powers()


def pieces(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with up to ``limit`` bytes of text, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > begin and held + size > limit:
            yield begin, at
            begin, held = at, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and where each begins; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def not_space(data: np.ndarray) -> np.ndarray:
    return ~((data == 32) | ((data >= 9) & (data <= 13)))


def letter_or_digit(data: np.ndarray) -> np.ndarray:
    """ASCII letters and digits, and all bytes of other characters."""
    small = data | 32
    return ((small >= 97) & (small <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)


def spans(
    data: np.ndarray, offsets: np.ndarray, inside_of=not_space
) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the texts, runs of the bytes ``inside_of``, begin and end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = inside_of(data)
    cut = offsets[1:-1]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[cut[cut < len(data)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[cut[cut > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def codes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A code for the bytes of every span."""
    up, down = _POWERS.first(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    sums = (total[ends] - total[starts]) * down[starts]
    return mix(sums + (ends - starts).astype(np.uint64) * _STEP)


def words_of(column: pa.Array, *, lower: bool = False, inside_of=not_space) -> Words:
    """The words of every text of an Arrow string column."""
    data, offsets = text_bytes(column)
    if lower:
        data = lower_ascii(data)
    starts, ends = spans(data, offsets, inside_of)
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, first, codes_of(data, starts, ends))


def runs(codes: np.ndarray, size: int) -> np.ndarray:
    """A code for every ``size`` consecutive words, also across the ends of texts."""
    count = max(0, len(codes) - size + 1)
    out = np.zeros(count, np.uint64)
    for at in range(size):
        out = out * _STEP + codes[at : count + at]
    return mix(out + np.uint64(size))


def within(first: np.ndarray, size: int) -> np.ndarray:
    """For every run of ``size`` words, whether it lies in one text."""
    total = int(first[-1])
    count = max(0, total - size + 1)
    ends = np.repeat(first[1:], np.diff(first))[:count]
    return np.arange(count) + size <= ends


def sliding(values: np.ndarray, size: int, take=np.minimum) -> np.ndarray:
    """The least (or ``take``) of every ``size`` consecutive values."""
    if len(values) < size:
        return values[:0]
    out, width = values, 1
    while width * 2 <= size:
        out = take(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return take(out[:-rest], out[rest:]) if rest else out


def minimizers(grams: np.ndarray, valid: np.ndarray, whole: np.ndarray, size: int):
    """Least gram of every window of ``size`` grams, and which grams are such a least one.

    ``valid`` marks grams within one text, ``whole`` windows within one text. Windows
    with the same words have the same least gram.
    """
    least = sliding(np.where(valid, grams, MOST), size)
    if not len(least):
        return least, np.zeros(len(grams), bool)
    shown = np.where(whole, least, _LEAST)
    edge = np.zeros(size - 1, np.uint64)
    reach = sliding(np.concatenate([edge, shown, edge]), size, np.maximum)
    return least, valid & (reach >= grams) & (reach > 0)
