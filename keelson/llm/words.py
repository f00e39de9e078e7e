"""Words of Arrow text columns as 64-bit hashes, in numpy over whole buffers.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased. Its hash stands for it: among V distinct
words a collision has a chance of about V * V / 2**65.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
MASK = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_A, _B, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def give_back() -> None:
    """Returns freed memory to the system. Worker processes live on between tasks, and would keep each task's peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_names(taken: list[str], wanted: list[str]) -> list[str]:
    """The wanted column names, with underscores in front as long as they are taken."""
    out = []
    for name in wanted:
        while name.lower() in {t.lower() for t in taken}:
            name = f"_{name}"
        out.append(name)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``limit`` bytes together; nulls are empty texts.

    A text is never cut: one longer than ``limit`` is a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1, offset=8 * column.offset)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text), texts one after another."""
    n, texts = len(data), len(offsets) - 1
    if not n:
        return np.empty(0, np.uint64), np.zeros(texts, np.int64)
    solid = ~SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]  # a text's end also ends a word
    first[cuts] = solid[cuts]
    last[cuts - 1] = solid[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    padded = np.zeros(n + 8, np.uint8)
    np.take(LOWER, data, out=padded[:n])
    eight = np.ndarray((n,), dtype="<u8", buffer=padded, strides=(1,))
    left = ends - starts
    hashes = mix(left.astype(np.uint64) * _GOLD + _A)
    rows = np.arange(len(starts))
    while len(rows):
        taken = eight[starts[rows]] & MASK[np.minimum(left, 8)]
        hashes[rows] = mix((hashes[rows] ^ taken) * _GOLD + _B)
        more = left > 8
        starts[rows] += 8
        rows, left = rows[more], left[more] - 8
    counts = np.diff(np.searchsorted(np.flatnonzero(first), offsets, side="left"))
    return hashes, counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``size`` words, runs per text); a shorter text is one run, an empty one has none."""
    runs = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    at = np.repeat(np.cumsum(counts) - counts, runs) + _within(runs)
    end = np.repeat(np.cumsum(counts), runs)
    h = np.full(len(at), 0x51ED270B, np.uint64)
    for i in range(size):
        inside = at + i < end
        word = np.where(inside, words[np.minimum(at + i, max(len(words) - 1, 0))], np.uint64(0)) if len(words) else h
        h = mix((h ^ word) * _GOLD + np.uint64(i + 1))
    return h, runs


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each group."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
