"""Words, lines and their 64-bit hashes of whole Arrow batches, as numpy arrays over the UTF-8 bytes.

Work goes through a batch in slices of bounded bytes (one document at least), so memory follows the slice and the
longest document, not the batch. After a batch, what the allocators keep of freed arrays goes back to the system, as
Python workers wait for later stages beside the executor's heap.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
U64 = np.uint64

_seeded = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _seeded.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_STEP = U64(0x9E3779B97F4A7C15)
_STEP_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = _seeded.integers(1, 2**63, 64, dtype=U64) * U64(2) + U64(1)
_powers = [np.ones(1, U64), np.ones(1, U64)]

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


_malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def released() -> None:
    """Gives memory that is free in this process back to the system, where its allocator can."""
    pa.default_memory_pool().release_unused()
    if _malloc_trim:
        _malloc_trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that sums of hashes don't keep the structure of their parts."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, step in enumerate((_STEP, _STEP_INV)):
            grown = np.full(size, step, U64)
            grown[0] = 1
            _powers[k] = np.multiply.accumulate(grown)
    return _powers[0], _powers[1]


@dataclass
class Texts:
    """Documents ``first`` to ``last`` of a batch: their bytes end to end, and where each starts and ends."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def count(self) -> int:
        return self.last - self.first

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each document has."""
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of flagged bytes that don't cross documents."""
        if not len(inside):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        edges = self.offsets[:-1][self.offsets[:-1] < len(inside)]
        starts[edges] = inside[edges]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = self.offsets[1:][self.offsets[1:] > 0] - 1
        ends[edges] = inside[edges]
        return np.flatnonzero(starts), np.flatnonzero(ends) + 1

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans."""
        up, down = _power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, U64)
        np.cumsum(_BYTE[self.data] * up[: len(self.data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * _STEP)


def slices(column: pa.ChunkedArray | pa.Array, lower: bool = False) -> Iterator[Texts]:
    """A string column as ``Texts``; a null counts as an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        end = min(end, n)
        part = data[offsets[at] : offsets[end]]
        yield Texts(at, end, LOWER[part] if lower else part, offsets[at : end + 1] - offsets[at])
        at = end
    released()


def gram_hashes(words: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words inside one document, and the index of each run's first word."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    sums = np.zeros(n, U64)
    for j in range(k):
        sums += words[j : j + n] * _GRAM[j]
    at = np.flatnonzero(docs[:n] == docs[k - 1 :])
    return mixed(sums[at]), at


def per_doc_sum(docs: np.ndarray, count: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(docs, weights, count).astype(np.int64)
