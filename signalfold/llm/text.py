"""Words of whole texts as hashed columns: the vectorised base of the text operators.

A word is ``[^\\x20\\x09-\\x0D]+``. Words are compared by 64-bit hashes of their bytes (multilinear,
then mixed), so two different words are taken as equal with a chance of about 2**-57 per pair.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 18  # the arrays made of a slice take some fifty times as much memory

# The C library keeps freed memory, and more and larger pieces of it as arrays come and go; workers live long and share an
# executor's memory. Where it is glibc, arrays of 1 MB and more are given back as they are freed, the rest by release().
_LIBC = ctypes.CDLL(None)
_TRIM = getattr(_LIBC, "malloc_trim", None)
if _TRIM:
    _LIBC.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD


def release() -> None:
    """Give memory that is no longer used back to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    start = (seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(start)) | np.uint64(1)


_AT = constants(4096, 1)
_FAR = constants(4096, 2)
_NTH = constants(256, 3)


@dataclass
class Words:
    """The words of a run of texts; text ``r`` has words ``first[r]:first[r + 1]``."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # text r is data[offsets[r]:offsets[r + 1]]
    starts: np.ndarray  # byte position of each word
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def find_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    offsets = offsets.astype(np.int64)
    solid = ~_SPACE[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = solid[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = solid[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(data, offsets, starts, ends, first, np.zeros(0, dtype=np.uint64))
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    where = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    letters = data[solid]
    if lower:
        letters = _LOWER[letters]
    weights = _AT[where & 4095]
    if lengths.max() > 4096:
        weights = weights * np.where(where < 4096, np.uint64(1), _FAR[(where >> 12) & 4095])
    sums = np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * weights, at)
    return Words(data, offsets, starts, ends, first, mix(sums + lengths.astype(np.uint64) * _FAR[0]))


def sliced(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) of runs of texts of about ``most`` bytes; null is empty.

    A text longer than that is a run of its own: texts are never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop
    release()


def word_runs(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Iterator[tuple[int, Words]]:
    """``sliced`` with the words found."""
    for row, data, offsets in sliced(column):
        yield row, find_words(data, offsets, lower)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each ``n`` consecutive words; the caller leaves out windows that cross texts."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for j in range(n):
        total += hashes[j : len(hashes) - n + 1 + j] * _NTH[j % 256]
    return mix(total + np.uint64(n))


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """For each text its ordered set of distinct ``n``-word shingles, as sorted hashes.

    Fewer words than ``n``: the whole sequence is the only shingle. No words: the empty set.
    """
    windows = window_hashes(words.hashes, n)
    sets = []
    for lo, hi in zip(words.first[:-1], words.first[1:], strict=True):
        if hi - lo >= n:
            sets.append(distinct(windows[lo : hi - n + 1]))
        elif hi > lo:
            sets.append(window_hashes(words.hashes[lo:hi], int(hi - lo)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]
