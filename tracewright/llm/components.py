"""Connected components of an edge table by alternating stars (Kiveris et al. 2014), and bounded Bloom filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written

SECTIONS = 64


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node. ``edges``: a, b (long).

    Each round rehangs neighbours on the least one in sight, so a chain halves; the edge table never grows. Rounds are
    written to the shared folder.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        hung = written(large, "edges")
        lower = hung.groupBy("u").agg(F.min("v").alias("m"))
        small = hung.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lower.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        then = written(small, "edges")
        after = _state(then)
        dropped(now, hung)
        now = then
        if after == state:
            break
        state = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


class Bloom:
    """Bits for 64-bit hashes, cut in sections by their top bits so that each is filled in one task."""

    def __init__(self, bits: np.ndarray, log_bits: int):
        self.bits, self.log_bits = bits, log_bits


    def held(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in bit_places(hashes, self.log_bits):
            out &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def bit_places(hashes: np.ndarray, log_bits: int) -> list[np.ndarray]:
    """Two places a hash: the top bits choose both, so they lie in the section of the same top bits."""
    first = hashes >> np.uint64(64 - log_bits)
    low = np.uint64((1 << (log_bits - 6)) - 1)
    return [first, (first & ~low) | ((hashes >> np.uint64(7)) & low)]


def bloom_of(ids: DataFrame, log_bits: int = 23) -> Bloom:
    """A filter of 2**log_bits bits over the column ``h`` (signed 64-bit hashes), whatever the row count."""

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sections: dict[int, np.ndarray] = {}
        each = 1 << (log_bits - 6)
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            for at in bit_places(h, log_bits):
                for s in np.unique(at // np.uint64(each)).tolist():
                    own = at[at // np.uint64(each) == s] % np.uint64(each)
                    sections.setdefault(int(s), np.zeros(each, bool))[own] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(sections), pa.int32()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in sections.values()], pa.binary())], names=["section", "bits"])

    bits = np.zeros(1 << (log_bits - 3), np.uint8)
    each = (1 << (log_bits - 6)) >> 3
    parts = ids.select("h").repartition(SECTIONS, F.shiftrightunsigned("h", 58)).mapInArrow(filled, "section int, bits binary")
    for r in parts.toLocalIterator():
        bits[r.section * each : (r.section + 1) * each] |= np.frombuffer(r.bits, np.uint8)
    return Bloom(bits, log_bits)
