"""Vectorised word hashes over Arrow string columns (words as in ``common.WORD``)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def split_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of a string column: (64-bit hashes, row of each word, first byte in its row, byte length)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buffer = column.buffers()[2] if len(column) else None
    data = np.frombuffer(buffer, np.uint8)[ends[0]:ends[-1]] if buffer is not None else np.empty(0, np.uint8)
    if not len(data):
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    ends = ends - ends[0]
    inside = ~_SEPARATOR[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    at_row = ends[:-1][ends[:-1] < len(data)]
    before[at_row] = False  # a word never crosses rows
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    within = np.flatnonzero(inside)
    first = np.searchsorted(within, starts)
    lengths = np.diff(np.append(first, len(within)))
    place = np.arange(len(within)) - np.repeat(first, lengths)
    power = np.cumprod(np.full(int(lengths.max()), _STEP))
    h = mix(np.add.reduceat(_BYTE[data[within]] * power[place], first) + lengths.astype(np.uint64))
    row = np.searchsorted(ends, starts, side="right") - 1
    return h, row, starts - ends[row], lengths


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of ``n`` consecutive numbers, one per start (the caller masks those that cross rows)."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for i in range(n):
        out = out * _STEP + h[i:len(out) + i]
    return mix(out)


def shingles(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every ``n``-word shingle; a row with fewer words has one shingle of all of them."""
    if not len(h):
        return h, row
    g = grams(h, n)
    same = row[: len(g)] == row[n - 1:] if len(g) else np.empty(0, bool)
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    count = np.diff(np.append(first, len(h)))
    short = count < n
    if not short.any():
        return g[same], row[: len(g)][same]
    extra = np.array([int(mix(np.array([int(sum((int(v) * (2 * i + 3)) for i, v in enumerate(h[f:f + c]))) & (1 << 64) - 1], np.uint64) + np.uint64(c))[0])
                      for f, c in zip(first[short].tolist(), count[short].tolist())], np.uint64)
    out, rows = np.concatenate([g[same], extra]), np.concatenate([row[: len(g)][same], row[first[short]]])
    order = np.argsort(rows, kind="stable")
    return out[order], rows[order]
