"""Words of whole Arrow batches of texts as numpy arrays: bounds and 64-bit hashes.

Every operator that looks at words inside tasks shares this kernel. It never makes a
Python object per word; a call works on about one megabyte of text (or on one text,
where that is longer), so a task's memory follows its longest text, not its batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_U = np.uint64
# Odd multipliers of the hash; any odd numbers would do, but they must stay the same everywhere.
_BASE, _MIX_A, _MIX_B = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASE_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)

BLANKS = np.zeros(256, bool)  # the bytes \x20 and \x09 to \x0D
BLANKS[[0x20, 9, 10, 11, 12, 13]] = True
SPACE_ONLY = np.zeros(256, bool)
SPACE_ONLY[0x20] = True
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = (h ^ (h >> _U(30))) * _MIX_A
    h = (h ^ (h >> _U(27))) * _MIX_B
    return h ^ (h >> _U(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def rolling_sums(data: np.ndarray, fold: np.ndarray = AS_IS) -> np.ndarray:
    """Prefix sums from which span_hashes() takes the hash of any span of bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[fold[data]] * _powers_up_to(len(data))[0][: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same bytes give the same hash wherever they stand."""
    inverse = _powers_up_to(len(sums))[1]
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


@dataclass
class Words:
    """Words of some texts, in order. Bounds are byte positions in ``data``."""

    data: np.ndarray
    text_bounds: np.ndarray  # n + 1 positions
    start: np.ndarray
    end: np.ndarray
    sums: np.ndarray
    first: np.ndarray  # n + 1 indexes into start: the words of each text

    @property
    def hashes(self) -> np.ndarray:
        return span_hashes(self.sums, self.start, self.end)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split(data: np.ndarray, bounds: np.ndarray, blanks=BLANKS, fold=LOWER) -> Words:
    """Words are the longest runs of bytes that are not blank; none crosses texts."""
    solid = ~blanks[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    start = np.flatnonzero(begins)
    return Words(data, bounds, start, np.flatnonzero(ends) + 1, rolling_sums(data, fold), np.searchsorted(start, bounds))


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # not the GNU library
    _TRIM = None


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives the task that needed most."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def returning_memory(task: Callable) -> Callable:
    """``task`` for mapInArrow, after which the worker returns what the task has freed.

    Idle workers of earlier stages count as memory of their executor, and give_back() in the midst
    of a task cannot return what the task still holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def text_slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, bounds) of consecutive texts of about ``limit`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high
    give_back()


def word_slices(column: pa.Array, blanks=BLANKS, fold=LOWER) -> Iterator[tuple[int, int, Words]]:
    for low, high, data, bounds in text_slices(column):
        yield low, high, split(data, bounds, blanks, fold)


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words.

    A text with fewer words has the whole sequence as its only run, one without words has none.
    """
    h = words.hashes
    runs = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        runs = mix(runs * _BASE + h[k : k + len(runs)])
    sets = []
    for low, high in zip(words.first[:-1], words.first[1:]):
        if high - low >= size:
            own = np.sort(runs[low : high - size + 1])
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif high > low:
            whole = np.full(1, high - low, np.uint64)
            for k in range(low, high):
                whole = mix(whole * _BASE + h[k])
            sets.append(whole)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
