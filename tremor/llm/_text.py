"""Byte-level helpers shared by the text operators.

Texts arrive as Arrow binary columns, so no decoding happens unless an
operator needs characters. Words are what lies between ``[\\x20\\x09-\\x0D]``;
those of a whole slice of texts are found and hashed at once on the column's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))


class Remembered(dict):
    """A dictionary that computes missing values by ``make`` and is emptied at ``limit`` entries; long keys aren't kept."""

    def __init__(self, make, limit: int = 100_000, longest: int = 64):
        self.make, self.limit, self.longest = make, limit, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def as_bytes(column: str = "text", docs: DataFrame | None = None) -> Column:
    """The UTF-8 bytes of a column (of ``docs``, whatever characters its name has); null becomes empty."""
    found = docs[f"`{column}`"] if docs is not None else F.col(f"`{column}`")
    return F.coalesce(found.cast("binary"), F.lit(b""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (murmur3 finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` values: a polynomial in wrapping 64-bit arithmetic, scrambled."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for k in range(width):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    return mix(acc)


def shingles(text: bytes, width: int = 5) -> np.ndarray:
    """Hashes of the word shingles of a text, in order, repeats kept.

    Words are lower-cased in A-Z only. A text of fewer words is one shingle of
    all its words; a text without words has none.
    """
    data = np.frombuffer(text, np.uint8)
    words, _, bounds = hash_words(data, np.array([0, len(data)]))
    return shingle_runs(words, bounds, width)[0]


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as asked for."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up, self.down


POWERS = _Powers(0x9E3779B97F4A7C15)
_BYTE_POWERS = _Powers(0xD1342543DE82EF95)
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True
#: A random number for each byte: the same for A-Z as for a-z, none for white space.
_BYTES = mix(np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64) + np.uint64(1))
_BYTES[_IS_WHITE] = 0
_STRETCH = 1 << 20  # bytes that are hashed at once, up to the next word


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of texts that lie side by side, where each begins, and the range of each text's words.

    ``data`` holds the bytes of all texts, ``offsets`` their bounds. A hash is
    a polynomial of the word's bytes, so all words are summed up at once; long
    texts go by stretches.
    """
    black = ~_IS_WHITE[data]
    begins = black.copy()
    begins[1:] &= ~black[:-1]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[at] = black[at]
    starts = np.flatnonzero(begins)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(starts, starts[i] + _STRETCH)), i + 1)
        end = int(starts[j]) if j < len(starts) else len(data)
        base = int(starts[i])
        up, down = _BYTE_POWERS.get(end - base)
        local = starts[i:j] - base
        out[i:j] = mix(np.add.reduceat(_BYTES[data[base:end]] * up[: end - base], local) * down[local])
        i = j
    return out, starts, np.searchsorted(starts, offsets)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of an Arrow binary column without nulls, not copied."""
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32, column.offset + len(column) + 1)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def shingle_runs(words: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of several texts, in order, and the range of each text's shingles.

    A text of fewer words is one shingle of all its words; one without words has none.
    """
    n = len(words)
    count = np.diff(bounds)
    out, valid = np.zeros(n, np.uint64), np.ones(n, bool)
    full = window_hashes(words, width)
    out[: len(full)] = full
    for back in range(1, width):
        valid[bounds[1:][count >= back] - back] = False
    for size in range(1, width):
        at = bounds[:-1][count == size]
        if len(at):
            acc = np.zeros(len(at), np.uint64)
            for k in range(size):
                acc = acc * np.uint64(0x9E3779B97F4A7C15) + words[at + k]
            out[at], valid[at] = mix(acc) ^ np.uint64(size), True
    edge = np.append(0, np.cumsum(np.where(count >= width, count - width + 1, np.minimum(count, 1))))
    return out[valid], edge


def batch_slices(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of few rows and bytes at a time (one row at least), not copied."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows)
            while part.num_rows > 1 and part.nbytes > size:
                part = part.slice(0, part.num_rows // 2)
            at += part.num_rows
            yield part
    pa.default_memory_pool().release_unused()  # a worker stays for other tasks


def column_shingles(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingle_runs` of an Arrow binary column."""
    words, _, bounds = hash_words(*text_buffers(column))
    return shingle_runs(words, bounds, width)


def sorted_sets(s: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each run in ascending order, and the range of each run."""
    s = s.copy()
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        s[a:b].sort()
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    new[edge[:-1][edge[:-1] < edge[1:]]] = True
    return s[new], np.append(0, np.cumsum(new))[edge]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, size: int = 8 << 20) -> Iterator[dict[str, list]]:
    """Python lists of few rows at a time, so that memory follows the rows at hand and not the Arrow batch."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows)
            while part.num_rows > 1 and part.nbytes > size:
                part = part.slice(0, part.num_rows // 2)
            at += part.num_rows
            yield part.to_pydict()


def to_signed(x: np.ndarray) -> np.ndarray:
    """uint64 values as the int64 that Spark's long holds."""
    return x.view(np.int64)
