"""CRC-32 of many spans of bytes at once."""

from __future__ import annotations

import zlib

import numpy as np

_ALL = np.uint32(0xFFFFFFFF)
_LONG = 64  # longer spans are few and taken one by one


def _table() -> np.ndarray:
    """What each byte does to the register, from the polynomial."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, np.uint32(0xEDB88320), np.uint32(0)) ^ (value >> np.uint32(1))
    return value


def crc32_spans(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None
) -> np.ndarray:
    """The unsigned CRC-32 of ``data[starts[i]:ends[i]]`` for every i.

    ``before`` holds a CRC for each span of bytes that come before it, as in
    ``zlib.crc32(span, before)``.
    """
    table = _table()
    out = np.zeros(len(starts), np.uint32) if before is None else before.astype(np.uint32)
    sizes = ends - starts
    for at in np.flatnonzero(sizes > _LONG).tolist():
        out[at] = zlib.crc32(data[starts[at] : ends[at]].tobytes(), int(out[at]))
    short = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
    order = short[np.argsort(-sizes[short], kind="stable")]
    state, place, left = out[order] ^ _ALL, starts[order], sizes[order]
    for at in range(int(left[0]) if len(left) else 0):
        live = int(np.searchsorted(-left, -at, side="left"))  # spans with more than ``at`` bytes
        now = state[:live]
        state[:live] = table[(now ^ data[place[:live] + at]) & np.uint32(255)] ^ (
            now >> np.uint32(8)
        )
    out[order] = state ^ _ALL
    return out
