"""Vectorised word and shingle hashing over Arrow string columns.

Words are the runs of bytes outside ``\\x20`` and ``\\x09-\\x0D`` with A-Z lower-cased; all work is
done on whole slices of an Arrow batch at once (no per-word Python). Slices hold a bounded number
of text bytes (or one document, if that alone is longer), so memory does not follow batch size.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SHINGLE_WORDS = 5

_R = np.uint64(0x9E3779B97F4A7C15)                      # odd, so it has an inverse mod 2**64
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_K = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
               0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)

_BYTE = np.arange(256, dtype=np.uint8)
IS_WORD = ~((_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D)))
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (all output bits depend on all input bits)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lean(run):
    """A map over Arrow batches that hands the memory it has freed back to the system when its partition is
    done. Spark keeps Python workers between tasks, and what their allocators hold on to adds up."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _POWERS.up = _POWERS.down = np.ones(1, dtype=np.uint64)
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped


class _Powers:
    """r**i and r**-i mod 2**64 for i below the longest slice seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __reduce__(self):  # executors fill their own
        return _Powers, ()

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full(max(n, SLICE_BYTES + 64), _R, dtype=np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = _R_INV
            self.down = np.cumprod(steps, dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row count, bytes, offsets) of consecutive slices; nulls count as empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_large_binary(col.type) or pa.types.is_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if n == 0:
        return
    buffers = col.buffers()
    off = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else _BYTE[:0]
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j - i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, row) of every word of a slice."""
    w = IS_WORD[data]
    if not len(w):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    first = np.empty(len(w), dtype=bool)
    first[0] = True
    np.logical_not(w[:-1], out=first[1:])
    bounds = off[1:-1]
    bounds = bounds[bounds < len(w)]
    first[bounds] = True
    last = np.empty(len(w), dtype=bool)
    last[-1] = True
    np.logical_not(w[1:], out=last[:-1])
    last[bounds[bounds > 0] - 1] = True
    starts = np.flatnonzero(w & first)
    ends = np.flatnonzero(w & last) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of byte spans: differences of polynomial prefix sums, then finalised."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _POWERS.get(len(data) + 1)
    b = (LOWER[data] if lower else data).astype(np.uint64)
    b += np.uint64(1)
    b *= up[:len(data)]
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(b, out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * _K[0])


def ngrams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of first word) of every n consecutive words within one row."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    s = np.full(m, np.uint64(n), dtype=np.uint64)
    for k in range(n):
        s = mix64(s * _K[2] + h[k:k + m] * _K[k % 5] + np.uint64(k)) if n > 5 else s + h[k:k + m] * _K[k]
    at = np.flatnonzero(row[:m] == row[n - 1:])
    return mix64(s[at]), at


def word_counts(row: np.ndarray, n_rows: int) -> np.ndarray:
    return np.bincount(row, minlength=n_rows)


def shingle_sets(col: pa.Array, n: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row of an Arrow string column. With fewer than
    ``n`` words the whole sequence is one shingle; without words the set is empty."""
    for first, rows, data, off in slices(col):
        starts, ends, row = words(data, off)
        h = hash_spans(data, starts, ends)
        g, at = ngrams(h, row, n)
        cuts = np.searchsorted(row[at], np.arange(rows + 1))
        wcuts = np.searchsorted(row, np.arange(rows + 1))
        for r in range(rows):
            a, b = cuts[r], cuts[r + 1]
            if b > a:
                s = np.sort(g[a:b])
                yield first + r, s if b - a == 1 else s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif wcuts[r + 1] > wcuts[r]:
                hw = h[wcuts[r]:wcuts[r + 1]]
                yield first + r, mix64(np.array([(hw * _K[:len(hw)]).sum() + np.uint64(len(hw))], dtype=np.uint64))
            else:
                yield first + r, g[:0]


def hash_word(word: str) -> int:
    """Hash of one word, equal to :func:`hash_spans` on a text that holds it."""
    b = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(hash_spans(b, np.array([0]), np.array([len(b)]))[0])
