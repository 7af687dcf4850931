"""Words and shingles of whole texts as 64-bit hashes, in numpy, batch by batch."""

from __future__ import annotations

import contextlib
import ctypes
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; longer texts are cut at white space.
BLOCK = 1 << 19

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_numbers = random.Random(7)
_BYTE = np.array([_numbers.getrandbits(64) for _ in range(256)], np.uint64)
_BASE = 0x9E3779B97F4A7C13  # odd
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` of them at least."""
    if not _POWERS or len(_POWERS["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, BLOCK + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def release() -> None:
    """Give memory of past batches back to the system: Python workers live on between
    tasks, and idle ones would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL(None).malloc_trim(0)


def row_groups(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes, or one row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of consecutive rows, and the first word of each row (one
    entry more than rows). A-Z count as a-z; words end at ASCII white space and at
    the end of a row."""
    base, end = int(offsets[0]), int(offsets[-1])
    hashes, starts = [], []
    at = base
    while at < end:
        to = min(at + BLOCK, end)
        if to < end:  # back to white space, or on to it where a word is as long as a block
            gaps = np.flatnonzero(~_IS_WORD[data[at:to]])
            if len(gaps):
                to = at + int(gaps[-1]) + 1
            else:
                while to < end and _IS_WORD[data[to]]:
                    to += 1
        block = data[at:to]
        inside = _IS_WORD[block]
        cuts = offsets[np.searchsorted(offsets, at, "left") : np.searchsorted(offsets, to, "left")] - at
        first = np.zeros(len(block) + 1, bool)
        first[cuts] = True
        first[len(block)] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | first[1:-1]
        s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        up, down = _powers(len(block) + 1)
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[block]] * up[: len(block)], out=sums[1:])
        found = (sums[e] - sums[s]) * down[s]
        hashes.append(mix(found ^ (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(s + at)
        at = to
    all_starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    all_hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return all_hashes, np.searchsorted(all_starts, offsets)


def row_shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the distinct ``k``-word shingles of one row's words, ascending. A row
    of fewer words has one shingle, the whole sequence; one without words has none."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(n, k)
    total = np.full(n - width + 1, k - width, np.uint64)
    for at in range(width):
        total = total * np.uint64(0x9FB21C651E98DF25) + hashes[at : n - width + 1 + at]
    total = np.sort(mix(total))
    keep = np.ones(len(total), bool)
    keep[1:] = total[1:] != total[:-1]
    return total[keep]


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The shingle set of every row of a text column."""
    data, offsets = raw(column)
    for a, b in row_groups(offsets):
        hashes, at = words(data, offsets[a : b + 1])
        for i in range(b - a):
            yield row_shingles(hashes[at[i] : at[i + 1]], k)
