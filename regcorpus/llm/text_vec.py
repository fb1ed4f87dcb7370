"""Vectorised words and word hashes over Arrow string columns (numpy).

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; in UTF-8 these
separators are never part of another character, so bytes and code points give
the same words.  Work goes through bounded slices of a batch; memory follows
the longest single text, not the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C55)  # odd, hence invertible modulo 2^64
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
SPAN = 1 << 20


def _byte_values(lower: bool) -> np.ndarray:
    v = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
    if lower:
        v[65:91] = v[97:123]
    return v


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def groups(column: pa.Array, limit: int = 4 << 20):
    """Yield ``(first_row, last_row, bytes, offsets)`` for slices of a string
    column that hold at most ``limit`` bytes (or one longer text); null is
    empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offs = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_spans(buf: np.ndarray, offs: np.ndarray, separators: np.ndarray = _SEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per text the index of its first
    word (one more entry than texts).  ``separators`` marks ASCII bytes."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    sep = separators[buf]
    first = ~sep
    first[1:] &= sep[:-1] | edge[1:n]
    last = ~sep
    last[:-1] &= sep[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


class WordHasher:
    """64-bit hash of every word from one running sum over the bytes."""

    def __init__(self, lower: bool = False):
        self.values = _byte_values(lower)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            one = np.ones(1, np.uint64)
            self.power = np.cumprod(np.concatenate([one, np.full(n - 1, _BASE)]), dtype=np.uint64)
            self.inverse = np.cumprod(np.concatenate([one, np.full(n - 1, _BASE_INV)]), dtype=np.uint64)

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SPAN, "right")))
            a, b = int(starts[i]), int(ends[j - 1])
            self._grow(max(b - a + 1, SPAN + 1))
            run = np.zeros(b - a + 1, np.uint64)
            np.cumsum(self.values[buf[a:b]] * self.power[:b - a], out=run[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = (run[e] - run[s]) * self.inverse[s] + (e - s).astype(np.uint64)
            i = j
        return mix(out)


def sequence_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes (``len(words) - n + 1``)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    k = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    total = np.zeros(m, np.uint64)
    for i in range(n):
        total += words[i:i + m] * k[i]
    return mix(total + np.uint64(n))


def joined_hash(words: np.ndarray) -> np.uint64:
    """Hash of one whole word sequence shorter than a window."""
    return sequence_hash(words, len(words))[0]
