"""Vectorised word and shingle hashing over Arrow string columns.

Everything here works on the UTF-8 bytes of a whole column slice with numpy, never on Python string
objects, so a worker's memory is a fixed multiple of ``CHUNK_BYTES`` (or of one longer text).

Words are maximal runs of anything but the six ASCII white-space bytes, after lower-casing A-Z only.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import hashlib

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SHINGLE_WORDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tidy(run):
    """Wraps a mapInArrow function: at a task's end the worker, which lives on, gives freed memory back to the system."""

    @functools.wraps(run)
    def tidied(*args):
        try:
            yield from run(*args)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return tidied


def _table(seed: int, n: int) -> np.ndarray:
    """n fixed odd 64-bit numbers (splitmix64)."""
    with np.errstate(over="ignore"):
        z = np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (z ^ (z >> np.uint64(31))) | np.uint64(1)


_PLACE = _table(13, SHINGLE_WORDS)
_LANE = _table(17, 1)[0]
#: Spans of more bytes are hashed one by one.
_LONG = 64
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finisher on uint64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def padded(d: np.ndarray) -> np.ndarray:
    """The bytes with eight more after them, as ``hash_spans`` reads eight at a time."""
    return np.concatenate([d, np.zeros(8, np.uint8)])


def hash_spans(d: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [s, e) of padded bytes.

    Eight bytes after eight are mixed in by a bijection, so spans of one length up to eight bytes never share a hash. No sum
    of powers: texts of a known structure (such as the Thue-Morse words) don't collide. Long spans take blake2b.
    """
    n = e - s
    out = mix64(n.astype(np.uint64) + _LANE)
    lanes = np.ndarray(max(len(d) - 7, 0), "<u8", d, strides=(1,))
    todo = np.flatnonzero((n > 0) & (n <= _LONG))
    at, left, h = s[todo], n[todo], out[todo]
    while len(todo):
        x = lanes[at] & _KEEP[np.minimum(left, 8)]
        with np.errstate(over="ignore"):
            h = mix64(h ^ (x * _LANE))
        out[todo] = h
        more = left > 8
        todo, at, left, h = todo[more], at[more] + 8, left[more] - 8, h[more]
    for i in np.flatnonzero(n > _LONG).tolist():
        out[i] = np.frombuffer(hashlib.blake2b(d[s[i] : e[i]], digest_size=8).digest(), "<u8")[0]
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null has no bytes."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Row ranges [a, b) of at most ``most`` bytes each; a longer text stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


class Words:
    """Words of rows [a, b): ``row`` (0-based in the range) and ``hash`` of each, in text order."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, a: int, b: int) -> None:
        o = (offsets[a : b + 1] - offsets[a]).astype(np.int64)
        d = data[offsets[a] : offsets[b]]
        self.rows, self.bytes, self.offsets = b - a, d, o
        word = ~_SPACE[d]
        edge = np.zeros(len(d) + 1, bool)
        edge[o] = True  # texts touch each other in the buffer
        start, stop = word.copy(), word.copy()
        start[1:] &= ~word[:-1] | edge[1 : len(d)]
        stop[:-1] &= ~word[1:] | edge[1 : len(d)]
        s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
        self._lower = padded(_LOWER[d])
        self.hash = self.span_hash(s, e)
        self.row = np.searchsorted(o, s, "right") - 1
        self.first = np.searchsorted(self.row, np.arange(self.rows + 1))
        self.start, self.stop = s, e

    def span_hash(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The hash of the lower-cased bytes [s, e) of each span; that of a whole word is its ``hash``."""
        return hash_spans(self._lower, s, e)

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """(first, hash): shingles of row i are hash[first[i]:first[i + 1]], repeats included.

        A row of fewer than five words has its whole sequence as one shingle; one without words has none.
        """
        k, h, first = SHINGLE_WORDS, self.hash, self.first
        count = np.diff(first)
        made = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
        at = np.concatenate([[0], np.cumsum(made)])
        out = np.empty(at[-1], np.uint64)
        with np.errstate(over="ignore"):
            if len(h) >= k:
                m = len(h) - k + 1
                acc = np.full(m, k, np.uint64)
                for j in range(k):
                    acc += h[j : j + m] * _PLACE[j]
                inside = self.row[:m] == self.row[k - 1 :]
                full = np.repeat(count >= k, made)
                out[full] = acc[inside]
            for i in np.flatnonzero((count > 0) & (count < k)):
                n = int(count[i])
                out[at[i]] = np.uint64(n) + (h[first[i] : first[i + 1]] * _PLACE[:n]).sum(dtype=np.uint64)
        return at, mix64(out)


def word_chunks(column: pa.Array, most: int = CHUNK_BYTES):
    """Yields (a, b, Words) over a whole column."""
    offsets, data = buffers(column)
    for a, b in chunks(offsets, most):
        yield a, b, Words(offsets, data, a, b)


def shingle_sets(column: pa.Array):
    """Yields the sorted distinct 64-bit shingle hashes of each text, in row order."""
    for a, b, words in word_chunks(column):
        at, h = words.shingles()
        for i in range(b - a):
            yield np.unique(h[at[i] : at[i + 1]])
