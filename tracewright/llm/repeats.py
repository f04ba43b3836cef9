"""Which 64-bit hashes occur more than once in a corpus, in bounded memory.

Hashes travel as packed 32-bit blobs by hash range and are counted there, each range in one task. Two summaries come
back: a Bloom filter of the hashes that occur twice or more (fixed size; once it fills up it only prunes less), and, if
asked for, the most frequent hashes (at most ``most_frequent``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import text_arrays as ta

BLOOM_BITS = 26
FLUSH = 1 << 21

HashesOf = Callable[[ta.Texts], np.ndarray]


def _emitted(parts_bits: int, hashes_of: HashesOf, lower: bool, all_counts: bool):
    """For mapInArrow over (text): (part, blob of the 32 bits below the part's)."""

    def flushed(held: list[np.ndarray]) -> pa.RecordBatch:
        ids = np.concatenate(held) if held else np.zeros(0, ta.U64)
        if all_counts:
            ids = ids[np.argsort((ids >> ta.U64(64 - parts_bits)).astype(np.int32), kind="stable")]
        else:
            ids = np.sort(ids)  # a third occurrence tells nothing more
            ids = ids[np.r_[True, True, ids[2:] != ids[:-2]][: len(ids)]]
        part = (ids >> ta.U64(64 - parts_bits)).astype(np.int32)
        low = ((ids >> ta.U64(32 - parts_bits)) & ta.U64(0xFFFFFFFF)).astype("<u4")
        edges = np.searchsorted(part, np.arange((1 << parts_bits) + 1))
        there = np.flatnonzero(np.diff(edges))
        return pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array([low[edges[p] : edges[p + 1]].tobytes() for p in there], pa.binary())], names=["part", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for t in ta.slices(batch.column(0), lower=lower):
                held.append(hashes_of(t))
                size += len(held[-1])
                if size >= FLUSH:
                    yield flushed(held)
                    held, size = [], 0
        yield flushed(held)
        held.clear()
        ta.released()

    return run


def _summarised(parts_bits: int, frequent: int, most_frequent: int):
    """For mapInArrow over (part, blob) dealt by part: a part's Bloom section and its frequent hashes."""
    section_bits = BLOOM_BITS - parts_bits
    most = max(1, most_frequent >> parts_bits)

    def summary(part: int, blobs: list[bytes]) -> tuple[bytes, bytes]:
        ids, times = np.unique(np.frombuffer(b"".join(blobs), "<u4"), return_counts=True)
        bits = np.zeros(1 << section_bits, bool)
        twice = (ids[times > 1].astype(ta.U64) | ta.U64(part << 32)) << ta.U64(32 - parts_bits)
        for at in _section_places(twice, parts_bits):
            bits[at.astype(np.int64)] = True
        often = np.flatnonzero(times >= frequent) if frequent else np.zeros(0, np.int64)
        if len(often) > most:
            often = often[np.argsort(-times[often], kind="stable")[:most]]
        return np.packbits(bits, bitorder="little").tobytes(), np.sort(ids[often]).astype("<u4").tobytes()

    def row(part: int, bits: bytes, often: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bits], pa.binary()), pa.array([often], pa.binary())], names=["part", "bits", "often"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blobs = None, []
        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if p != part and part is not None:
                    yield row(part, *summary(part, blobs))
                    blobs = []
                part = p
                blobs.append(blob.as_py())
        if part is not None:
            yield row(part, *summary(part, blobs))
        blobs.clear()
        ta.released()

    return run


def _section_places(ids: np.ndarray, parts_bits: int) -> list[np.ndarray]:
    """Two places within a part's section, of hashes cut to the part's bits and the 32 below."""
    mask = ta.U64((1 << (BLOOM_BITS - parts_bits)) - 1)
    mixed = ta.mixed(ids >> ta.U64(32 - parts_bits))
    return [mixed & mask, (mixed >> ta.U64(32)) & mask]


class Frequencies:
    """What is known of all hashes' frequencies, in bounded memory."""

    def __init__(self, parts_bits: int, bits: np.ndarray, often: np.ndarray):
        self.parts_bits, self.bits, self.often = parts_bits, bits, often

    def cut(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> ta.U64(32 - self.parts_bits)

    def frequent(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.often):
            return np.zeros(len(hashes), bool)
        ids = self.cut(hashes)
        at = np.minimum(np.searchsorted(self.often, ids), len(self.often) - 1)
        return self.often[at] == ids

    def repeated(self, hashes: np.ndarray) -> np.ndarray:
        """False only for hashes that occur once."""
        section = (hashes >> ta.U64(64 - self.parts_bits)) << ta.U64(BLOOM_BITS - self.parts_bits)
        out = np.ones(len(hashes), bool)
        for at in _section_places(self.cut(hashes) << ta.U64(32 - self.parts_bits), self.parts_bits):
            place = section + at
            out &= (self.bits[place >> ta.U64(3)] >> (place & ta.U64(7)).astype(np.uint8)) & 1 > 0
        return out


def frequencies(docs: DataFrame, hashes_of: HashesOf, lower: bool = False, frequent: int = 0, most_frequent: int = 0) -> Frequencies:
    """Over all of ``docs.text``. ``frequent``: from how many occurrences on a hash counts as frequent; 0: none does."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts_bits = min(16, max(6, (4 * n - 1).bit_length()))
    blobs = docs.select("text").mapInArrow(_emitted(parts_bits, hashes_of, lower, bool(frequent)), "part int, blob binary")
    parts = blobs.repartition(n, "part").sortWithinPartitions("part").mapInArrow(_summarised(parts_bits, frequent, most_frequent), "part int, bits binary, often binary")
    bits, often = np.zeros(1 << (BLOOM_BITS - 3), np.uint8), []
    each = (1 << (BLOOM_BITS - parts_bits)) >> 3
    for r in parts.toLocalIterator():
        bits[r.part * each : (r.part + 1) * each] = np.frombuffer(r.bits, np.uint8)
        often.append(np.frombuffer(r.often, "<u4").astype(ta.U64) | ta.U64(r.part << 32))
    return Frequencies(parts_bits, bits, np.sort(np.concatenate(often)) if often else np.zeros(0, ta.U64))
