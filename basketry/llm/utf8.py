"""Texts of an Arrow column as one array of UTF-8 bytes; hashes of words and shingles.

Everything works on slices of a few megabytes, so the memory of a task follows the longest
single text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

# The white space that separates words, and the letters that lose their case.
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
IS_SPACE = np.isin(np.arange(256), list(SPACES))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.default_rng(20240501)
BYTE_KEYS = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base modulo 2^64, and of its inverse."""
    while len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            have = _powers[k]
            _powers[k] = np.concatenate([have, have * np.uint64(pow(base, len(have), 2**64))])
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits; a one-to-one function."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``SLICE_BYTES`` (one row at least): first, end, bytes, offsets.

    A NULL counts as the empty text. Offsets are relative to the run's bytes. At the end the memory that
    Arrow keeps for later goes back, since workers live on between tasks.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end
    pa.default_memory_pool().release_unused()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes, equal for equal spans wherever they stand."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_KEYS[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a run of texts, lower-cased in A-Z unless told not to, and where each text's words begin."""
    inside = ~IS_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    full = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[full] = False
    after[full[full > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return span_hashes(LOWER[data] if lower else data, starts, ends), np.searchsorted(starts, offsets)


def word_shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles of k words; with fewer words, the whole sequence is the only one."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(_BASE) + hashes[i : n - width + 1 + i])
    return np.unique(out)
