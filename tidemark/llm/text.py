"""Words of whole texts as numpy arrays of hashes.

A word is a longest run of bytes other than ASCII white space (0x20, 0x09 to
0x0D), so UTF-8 texts are cut exactly where ``[^\\x20\\x09-\\x0D]+`` cuts them.
Texts arrive as Arrow binary columns; nothing is decoded.  Work goes in
segments of a few megabytes, so memory does not depend on the text's length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SEGMENT = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def as_bytes(name: str = "text") -> Column:
    """A text column as bytes, for Arrow without decoding."""
    return F.col(name).cast("binary")


def mix64(values: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (the finalizer of SplitMix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _letters(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] = codes[97:123]
    return mix64(codes * np.uint64(_BASE) + np.uint64(12345)) | np.uint64(1)


_LETTERS = {False: _letters(False), True: _letters(True)}
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(0, np.uint64), np.ones(0, np.uint64))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < size:
        size = max(size, 1 << 16)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up), np.cumprod(down))
    return _powers


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a binary column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None:
        return at - at[0], np.zeros(0, np.uint8)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0] : at[-1]]


def word_spans(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last byte of each word; no word reaches over the end of its text."""
    inside = ~_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    full = np.flatnonzero(np.diff(offsets) > 0)
    before[offsets[full]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[full + 1] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each span, by prefix sums of a polynomial over scattered letters."""
    out = np.zeros(len(starts), np.uint64)
    letters = _LETTERS[lower]
    first = 0
    while first < len(starts):
        last = max(int(np.searchsorted(ends, starts[first] + SEGMENT, "right")), first + 1)
        low, high = starts[first], ends[last - 1]
        up, down = _power_tables(int(high - low) + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(letters[data[low:high]] * up[: high - low], out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix64((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        first = last
    return out


def hash_words(offsets: np.ndarray, data: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch and, for each text, where its words begin (one more than texts)."""
    starts, ends = word_spans(offsets, data)
    return hash_spans(data, starts, ends, lower), np.searchsorted(starts, offsets)


def ngrams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; fewer words give one hash of them all, none give none."""
    size = min(size, len(words))
    if not size:
        return words[:0]
    count = len(words) - size + 1
    total = np.full(count, np.uint64(size), np.uint64)
    for k in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[k : k + count]
    return mix64(total)


def slices(offsets: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or a single longer text."""
    first = 0
    while first < len(offsets) - 1:
        last = max(int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1, first + 1)
        yield first, last
        first = last


def give_back() -> None:
    """Return memory that is no longer used to the system: workers live on and share an executor with others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task that needs much memory, which is given back at its end."""
    try:
        yield from batches
    finally:
        give_back()
