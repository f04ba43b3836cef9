"""Which tokens (64-bit hashes) of each document occur in other documents too, over a corpus of any size.

Documents are dealt into buckets by id. Each bucket sends its tokens, cut to some 40 bits and packed, to the task of
their hash range; there those that occur in two documents or more are found and sent back to the buckets that hold them;
the documents, dealt into the same buckets once more, meet them there. A bucket sends a token twice at most for some
``FLUSH`` tokens, so a very common one weighs nothing. The cut can only make a token seem shared that isn't.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_arrays as ta
from .common import written

FLUSH = 1 << 20
LOW_BITS = 32
PACKED = "part int, bucket int, low binary"

TokensOf = Callable[[ta.Texts], tuple[np.ndarray, np.ndarray]]


class Shared:
    """The shared tokens among those of a bucket."""

    def __init__(self, cuts: np.ndarray, parts_bits: int):
        self.cuts, self.shift = cuts, ta.U64(64 - LOW_BITS - parts_bits)

    def holds(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.cuts):
            return np.zeros(len(tokens), bool)
        cut = tokens >> self.shift
        return self.cuts[np.minimum(np.searchsorted(self.cuts, cut), len(self.cuts) - 1)] == cut


def _cuts(docs: np.ndarray, tokens: np.ndarray, parts_bits: int) -> np.ndarray:
    """The cut tokens, once per document; ``docs`` in order."""
    cut = tokens >> ta.U64(64 - LOW_BITS - parts_bits)
    out, at = [], 0
    bits = 64 - LOW_BITS - parts_bits  # left for the document's number
    while at < len(docs):
        end = int(np.searchsorted(docs, docs[at] + (1 << bits)))
        pairs = np.sort(cut[at:end] << ta.U64(bits) | (docs[at:end] - docs[at]).astype(ta.U64))
        out.append(pairs[np.r_[True, pairs[1:] != pairs[:-1]]] >> ta.U64(bits))
        at = end
    return np.concatenate(out) if out else np.zeros(0, ta.U64)


def _sent(tokens_of: TokensOf, parts_bits: int, lower: bool):
    """For mapInArrow over (bucket, text)."""

    def packed(bucket: int, held: list[np.ndarray]) -> pa.RecordBatch:
        cut = np.sort(np.concatenate(held))
        cut = cut[np.r_[True, True, cut[2:] != cut[:-2]][: len(cut)]]  # a third document tells nothing more
        edges = np.searchsorted(cut, np.arange((1 << parts_bits) + 1, dtype=ta.U64) << ta.U64(LOW_BITS))
        low = cut.astype("<u4")
        parts = np.flatnonzero(np.diff(edges))
        blobs = pa.array([low[edges[p] : edges[p + 1]].tobytes() for p in parts.tolist()], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(np.full(len(parts), bucket, np.int32)), blobs], names=["part", "bucket", "low"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            for t in ta.slices(batch.column(1), lower=lower):
                docs, tokens = tokens_of(t)
                of_doc = buckets[t.first : t.last]
                for b in np.unique(of_doc).tolist():
                    own = slice(None) if (of_doc == b).all() else of_doc[docs] == b
                    held.setdefault(b, []).append(_cuts(docs[own], tokens[own], parts_bits))
                while sum(len(x) for own in held.values() for x in own) >= 2 * FLUSH:
                    largest = max(held, key=lambda b: sum(map(len, held[b])))
                    yield packed(largest, held.pop(largest))
        for b in list(held):
            yield packed(b, held.pop(b))
        ta.released()

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (part, bucket, low) ordered by part: of each blob the tokens that occur twice in the part."""

    def shared(part: int, buckets: list[int], blobs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        every = np.concatenate(blobs)
        order = np.sort(every)
        twice = order[1:][order[1:] == order[:-1]]
        if not len(twice):
            return
        there = twice[np.minimum(np.searchsorted(twice, every), len(twice) - 1)] == every
        edges = np.concatenate(([0], np.cumsum([len(x) for x in blobs]))).tolist()
        found = [np.unique(x[there[a:b]]) for x, a, b in zip(blobs, edges[:-1], edges[1:], strict=True)]
        kept = [k for k, x in enumerate(found) if len(x)]
        low = pa.array([found[k].tobytes() for k in kept], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kept), part, np.int32)), pa.array([buckets[k] for k in kept], pa.int32()), low], names=["part", "bucket", "low"])

    now, buckets, blobs = None, [], []
    for batch in batches:
        for part, bucket, low in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if part != now and blobs:
                yield from shared(now, buckets, blobs)
                buckets, blobs = [], []
            now = part
            buckets.append(bucket)
            blobs.append(np.frombuffer(low.as_py(), "<u4"))
    if blobs:
        yield from shared(now, buckets, blobs)
    blobs = []
    ta.released()


def _returned(rows_of, parts_bits: int, lower: bool):
    """For mapInArrow over (bucket, doc_id, text, part, low) with a bucket's shared tokens before its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blobs, shared = None, [], None
        for batch in batches:
            buckets, is_doc = batch.column(0).to_numpy(), batch.column(3).is_null().to_numpy(zero_copy_only=False)
            firsts = np.flatnonzero(np.r_[True, (buckets[1:] != buckets[:-1]) | (is_doc[1:] != is_doc[:-1])][: len(batch)])
            for a, b in zip(firsts.tolist(), [*firsts[1:].tolist(), len(batch)], strict=True):
                if buckets[a] != bucket:
                    bucket, blobs, shared = buckets[a], [], None
                if not is_doc[a]:
                    for part, low in zip(batch.column(3)[a:b].to_pylist(), batch.column(4)[a:b], strict=True):
                        blobs.append(np.frombuffer(low.as_py(), "<u4").astype(ta.U64) | ta.U64(part << LOW_BITS))
                    continue
                if shared is None:
                    shared = Shared(np.unique(np.concatenate(blobs)) if blobs else np.zeros(0, ta.U64), parts_bits)
                    blobs = []
                own = batch.slice(a, b - a).select([1, 2])
                for t in ta.slices(own.column(1), lower=lower):
                    yield rows_of(t, own.slice(t.first, t.count), shared)

    return run


def shared_tokens(docs: DataFrame, tokens_of: TokensOf, rows_of: Callable[[ta.Texts, pa.RecordBatch, Shared], pa.RecordBatch], schema: str, lower: bool = False) -> DataFrame:
    """``rows_of(texts, (doc_id, text), shared tokens)`` of all of (doc_id, text)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts_bits = min(24, max(4, (n - 1).bit_length()))
    number = F.xxhash64(F.coalesce("doc_id", F.xxhash64("text")))
    dealt = docs.select(F.pmod(number, F.lit(n)).cast("int").alias("bucket"), "doc_id", "text")
    sent = dealt.select("bucket", "text").repartition(n, "bucket").mapInArrow(_sent(tokens_of, parts_bits, lower), PACKED)
    # written, so that the shuffles on the way there are gone before the way back
    met = written(sent.repartition(n, "part").sortWithinPartitions("part").mapInArrow(_met, PACKED), "shared-tokens")
    none = dealt.select("bucket", "doc_id", "text", F.lit(None).cast("int").alias("part"), F.lit(None).cast("binary").alias("low"))
    tokens = met.select("bucket", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "part", "low")
    rows = none.unionByName(tokens).repartition(n, "bucket").sortWithinPartitions("bucket", F.col("part").asc_nulls_last())
    return rows.mapInArrow(_returned(rows_of, parts_bits, lower), schema)
