"""Vectorised words and n-gram hashes over Arrow string columns.

A word is a run of bytes other than U+0020 and U+0009..U+000D (``[^\\x20\\x09-\\x0D]+``). Everything works on
the UTF-8 buffers of an Arrow array, so no Python string is made per word. Nulls count as empty texts.
Hashes are 64-bit and depend on the bytes alone, so every executor and every rerun gives the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Text bytes that one vectorised step looks at; bounds the memory of a task whatever the texts' lengths.
STEP_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_MULTIPLIERS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, STEP_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; a null row has no bytes."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of consecutive rows ``first`` to ``first + rows - 1``.

    ``start`` and ``end`` are byte places in ``data``; ``row`` is the row of a word from 0 within this part;
    ``bounds[i]:bounds[i + 1]`` are the words of row i; ``text_at`` are the rows' byte places in ``data``.
    """

    first: int
    rows: int
    data: np.ndarray
    text_at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    row: np.ndarray
    bounds: np.ndarray

    def text_of(self, row: int) -> bytes:
        return self.data[self.text_at[row] : self.text_at[row + 1]].tobytes()


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of at most about STEP_BYTES that end at a row's end or between words."""
    at, end = 0, len(data)
    while at < end:
        stop = min(end, at + STEP_BYTES)
        if stop < end:
            row = int(np.searchsorted(offsets, stop, "right")) - 1
            if offsets[row] > at:
                stop = int(offsets[row])
            else:
                here = int(offsets[row + 1])
                while stop < here:
                    gap = np.flatnonzero(~_IS_WORD[data[stop : min(here, stop + STEP_BYTES)]])
                    if len(gap):
                        stop += int(gap[0])
                        break
                    stop = min(here, stop + STEP_BYTES)
        yield at, stop
        at = stop


def _part(data: np.ndarray, offsets: np.ndarray, first: int, lower: bool) -> Words:
    table = _BYTE_LOWER if lower else _BYTE
    starts, ends, hashes = [], [], []
    for lo, hi in _pieces(data, offsets):
        some = data[lo:hi]
        word = _IS_WORD[some]
        edge = np.zeros(hi - lo + 1, dtype=bool)
        inner = offsets[np.searchsorted(offsets, lo, "left") : np.searchsorted(offsets, hi, "right")] - lo
        edge[inner] = True
        edge[0] = True
        before = np.empty_like(word)
        before[0] = False
        before[1:] = word[:-1]
        s = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.empty_like(word)
        after[-1] = False
        after[:-1] = word[1:]
        e = np.flatnonzero(word & (~after | edge[1:] | (np.arange(hi - lo) == hi - lo - 1))) + 1
        up, down = _powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(table[some] * up[: hi - lo], out=total[1:])
        hashes.append(mix64((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
        starts.append(s + lo)
        ends.append(e + lo)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    value = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    bounds = np.searchsorted(start, offsets, "left")
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(first, len(offsets) - 1, data, offsets, start, end, value, row, bounds)


def parts(texts: pa.Array, lower: bool = False, most: int = STEP_BYTES) -> Iterator[Words]:
    """The words of a column in parts of whole rows with about ``most`` bytes; a longer row is a part of its own."""
    data, offsets = buffers(texts)
    n, row = len(offsets) - 1, 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        stop = min(n, max(stop, row + 1))
        yield _part(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], row, lower)
        row = stop


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` consecutive words of one row, and the word index at which each starts."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        total += words.hash[j : n + j] * _MULTIPLIERS[j % 64]
    at = np.flatnonzero(words.row[:n] == words.row[k - 1 :])
    return mix64(total[at]), at
