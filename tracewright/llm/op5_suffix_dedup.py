"""Suffix-array deduplication: remove every byte covered by a 100-byte string that also starts earlier.

The order of all suffixes is needed only to a depth of ``LENGTH`` bytes, and only where a string can repeat. As in the
difference-cover algorithm, a sample of suffixes is sorted first and named, and the others follow from them by their
distance to the next sampled one. The cover is content-defined (a synchronising set: the least 8-byte gram of every
``COVER`` successive ones) instead of residues modulo 3: two equal strings of ``LENGTH`` bytes hold their sampled
position at the same distance, which is all a cover must give, and 6 % of the positions are sampled instead of 67 %.

1. Sample. Successive strings that share a sampled position form a stretch. The name of a stretch's core (the
   ``LENGTH - COVER + 1`` bytes from the sampled position, which all its strings contain) is a fingerprint. Cores that
   occur once in the corpus are dropped with the filter of ``repeats``.
2. Sort sampled triples: what stands before the core, the core, and what follows, as (core name, name of the whole
   stretch), then place. Neighbours in this order are compared: a stretch equal to its predecessor is a copy, all of
   whose strings start earlier elsewhere; the first of its kind among stretches of another kind goes on.
3. One fixed second pass, no recursion on ranks: the single strings of those, named by (core name, own fingerprint), are sorted, and
4. compared with their neighbours: equal names and an earlier place before them mean repetition.

Both sorts are range shuffles on (names, place), so one core with a third of all rows still spreads evenly; at the edges
of sorted partitions the last and first entries are compared on the driver, a few rows a partition. Names are pairs of
64-bit fingerprints; their order is that of the fingerprints, as only equality of neighbours counts.

Nulls: a null text is empty. A null id counts as the least. Rows of one id and text are one document, so they get equal
answers and are no copies of each other; rows of one id with other texts are ordered by a hash of the text. Texts
shorter than ``LENGTH`` bytes lose nothing. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text_arrays as ta
from .common import dropped, table, written
from .components import Bloom, bloom_of
from .repeats import Frequencies, frequencies

LENGTH = 100
COVER = 32
GRAM = 8
CORE = LENGTH - COVER + 1
LEAST_ID = -(1 << 63)
ENTRIES = "core long, name long, doc long, version long, at int, n int"
SORTED = "kind string, part int, " + ENTRIES
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

COPY, MIXED, EDGE = "copy", "mixed", "edge"


def stretches(t: ta.Texts) -> tuple[np.ndarray, ...]:
    """Document, first string's start, number of strings, core name and stretch name of each stretch."""
    none = np.zeros(0, np.int64)
    counts = np.maximum(np.diff(t.offsets) - LENGTH + 1, 0)
    if not counts.sum():
        return none, none, none, none.view(ta.U64), none.view(ta.U64)
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(t.data, GRAM)).view("<u8").ravel()
    key = (ta.mixed(grams) & ta.U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=ta.U64)
    size = 1
    while size < COVER:  # the leftmost least gram among COVER
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    p = np.arange(counts.sum()) + np.repeat(t.offsets[:-1] - (np.cumsum(counts) - counts), counts)
    sampled = (key[p] & ta.U64(0xFFFFFFFF)).astype(np.int64)
    docs = np.repeat(np.arange(t.count), counts)
    new = np.ones(len(p), bool)
    new[1:] = (sampled[1:] != sampled[:-1]) | (docs[1:] != docs[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(p)))
    start, core = p[first], sampled[first]
    names = t.hashes(np.concatenate((core, start)), np.concatenate((core + CORE, start + n - 1 + LENGTH)))
    return docs[first], start - t.offsets[docs[first]], n, names[: len(first)], names[len(first) :]


def core_names(t: ta.Texts) -> np.ndarray:
    return stretches(t)[3]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _entries(core, name, doc, version, at, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(_signed(core)), pa.array(_signed(name)), doc, version, pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=[c.split()[0] for c in ENTRIES.split(", ")])


def _sampled(known):
    """For mapInArrow over (doc, version, text): the stretches whose core may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Frequencies = known.value
        for batch in batches:
            for t in ta.slices(batch.column(2)):
                docs, at, n, core, name = stretches(t)
                good = np.flatnonzero(seen.repeated(core))
                rows = pa.array(docs[good] + t.first)
                yield _entries(core[good], name[good], batch.column(0).take(rows), batch.column(1).take(rows), at[good], n[good])

    return run


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc, version, text, starts): every string of the stretches that begin at ``starts``."""
    for batch in batches:
        for t in ta.slices(batch.column(2)):
            docs, at, n, core, _ = stretches(t)
            lists = batch.column(3).slice(t.first, t.count)
            wanted = np.repeat(np.arange(t.count), pc.list_value_length(lists).to_numpy()) << 32 | lists.flatten().to_numpy()
            chosen = np.flatnonzero(np.isin(docs << 32 | at, wanted))
            each = np.repeat(chosen, n[chosen])
            starts = at[each] + np.arange(len(each)) - np.repeat(np.cumsum(n[chosen]) - n[chosen], n[chosen])
            place = t.offsets[docs[each]] + starts
            rows = pa.array(docs[each] + t.first)
            yield _entries(core[each], t.hashes(place, place + LENGTH), batch.column(0).take(rows), batch.column(1).take(rows), starts, np.ones(len(each), np.int32))


def _compared(keep_mixed: bool):
    """For mapInArrow over entries in order: each compared with the one before.

    Yields copies, first of their kind in a core of several kinds (``mixed``, if kept), and as ``edge`` the entries at a
    partition's ends that need its neighbours: its first; the first of each kind that alone holds the partition's first
    or last core here, or a second kind of its first core; its last; and the first of the last kind.
    """

    def batch_of(kind: str, part: int, cols: list[np.ndarray]) -> pa.RecordBatch:
        n = len(cols[0])
        return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.string()), pa.array(np.full(n, part, np.int32)), *map(pa.array, cols)], names=[c.split()[0] for c in SORTED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = lead = None  # rows as one-entry columns: the first of all, the last seen, the first of the last's kind
        alone = None  # the first entry of the open core, while it has one kind
        first_core = True
        edges: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if first is None:
                first = last = lead = alone = [c[:1] for c in cols]
                cols = [c[1:] for c in cols]
                if not len(cols[0]):
                    continue
            core, name, doc, version, at, _ = cols
            before = [np.concatenate((b, c[:-1])) for b, c in zip(last, cols, strict=True)]
            new_core = core != before[0]
            new_kind = new_core | (name != before[1])
            # place of the first of the same kind
            heads = np.concatenate(([-1], np.flatnonzero(new_kind)))
            head = heads[np.cumsum(new_kind)]
            elsewhere = [c != np.where(head < 0, b, c[head]) for b, c in zip(lead[2:5], (doc, version, at), strict=True)]
            copy = ~new_kind & np.logical_or.reduce(elsewhere)
            if copy.any():
                yield batch_of(COPY, part, [c[copy] for c in cols])
            if keep_mixed:
                block = np.cumsum(new_core)  # 0: the core that is open
                kinds = np.bincount(block[new_kind], minlength=block[-1] + 1)
                opened_alone, opened_first = alone, first_core
                several = kinds > 1
                several[0] = opened_alone is None or kinds[0] > 0
                mixed = new_kind & several[block]
                if opened_alone is not None and several[0]:
                    yield batch_of(MIXED, part, opened_alone)
                    if opened_first:  # tells the partition before that there are more kinds
                        edges.append([c[np.flatnonzero(new_kind)[:1]] for c in cols])
                    alone = None
                if mixed.any():
                    yield batch_of(MIXED, part, [c[mixed] for c in cols])
                if block[-1]:
                    if opened_first and alone is not None:
                        edges.append(alone)  # the first core of the partition, with one kind here
                    first_core = False
                    alone = [c[np.flatnonzero(new_core)[-1] :][:1] for c in cols] if kinds[-1] == 1 else None
            last = [c[-1:] for c in cols]
            if head[-1] >= 0:
                lead = [c[head[-1] :][:1] for c in cols]
        if first is not None:
            if alone is not None:
                edges.append(alone)
            for row in (first, *edges, last, lead):
                yield batch_of(EDGE, part, row)

    return run


def _at_edges(rows: list, keep_mixed: bool) -> list[tuple]:
    """Copies and mixed entries that only the neighbouring partitions show; a few rows a partition."""
    place = lambda r: (r.doc, r.version, r.at)
    parts: dict[int, list] = {}
    for r in rows:
        parts.setdefault(r.part, []).append(r)
    out: list[tuple] = []
    whole = [parts[p] for p in sorted(parts)]
    # a partition's first entry, against the first of its kind in the partitions before
    lead = None
    kinds: dict[int, set[int]] = {}
    single: dict[int, list] = {}
    for own in whole:
        first, last = own[0], own[-2]
        if lead is not None and (lead.core, lead.name) == (first.core, first.name):
            if place(lead) != place(first):
                out.append((COPY, first))
            if (last.core, last.name) != (first.core, first.name):
                lead = own[-1]
        else:
            lead = own[-1]
        for r in own:
            kinds.setdefault(r.core, set()).add(r.name)
        for r in own[1:-2]:
            single.setdefault(r.core, []).append(r)
    if keep_mixed:
        for core, entries in single.items():
            if len(kinds[core]) > 1:
                seen = set()
                for r in sorted(entries, key=lambda r: (r.name, place(r))):
                    if r.name not in seen:
                        out.append((MIXED, r))
                    seen.add(r.name)
    return [(kind, -1, r.core, r.name, r.doc, r.version, r.at, r.n) for kind, r in out]


def compared(entries: DataFrame, label: str, keep_mixed: bool) -> DataFrame:
    """Sorts the entries by names and place, and compares each with the one before: (kind, ...) as a written table."""
    spark = entries.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["core", "name", "doc", "version", "at"]
    rows = entries.repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = written(rows.mapInArrow(_compared(keep_mixed), SORTED), label)
    more = spark.createDataFrame(_at_edges(found.where(F.col("kind") == EDGE).collect(), keep_mixed), SORTED)
    return found.where(F.col("kind") != EDGE).unionByName(more)


def identified(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, doc, version, text, *keep): ``doc`` without nulls, ``version`` tells rows of one id apart by their text."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))
    rows = docs.select(F.col("doc_id").cast("long"), doc.alias("doc"), "text", *(keep or []))
    again = rows.groupBy("doc").count().where("count > 1").select("doc")
    if again.isEmpty():
        return rows.withColumn("version", F.lit(0).cast("long"))
    return rows.join(again.withColumn("_again", F.lit(True)), "doc", "left").withColumn("version", F.when(F.col("_again"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))).drop("_again")


def _id_hash() -> Column:
    return F.xxhash64("doc", "version")


def _held(bloom, inside: bool):
    """A function of a hash Column: whether the filter may hold it, or surely doesn't. Only hashes go to Python."""

    @F.arrow_udf("boolean")
    def run(hashes: pa.Array) -> pa.Array:
        return pa.array(bloom.value.held(hashes.to_numpy(zero_copy_only=False).view(np.uint64)) == inside)

    return run


def repeated_strings(docs: DataFrame) -> DataFrame:
    """(doc, version, at, n): the n strings from byte ``at`` on also start earlier. ``docs``: doc, version, text."""
    spark = docs.sparkSession
    docs = docs.select("doc", "version", "text")
    known = spark.sparkContext.broadcast(frequencies(docs, core_names))
    sampled = written(docs.mapInArrow(_sampled(known), ENTRIES), "sampled")
    known.unpersist()
    found = compared(sampled, "stretches", True)
    starts = found.where(F.col("kind") == MIXED).groupBy("doc", "version").agg(F.collect_list("at").alias("starts"))
    starts = written(starts, "mixed")
    dropped(sampled)
    bloom = spark.sparkContext.broadcast(bloom_of(starts.select(_id_hash().alias("h"))))
    some = docs.where(_held(bloom, True)(_id_hash()))
    singles = some.join(starts, ["doc", "version"]).select("doc", "version", "text", "starts").mapInArrow(_single, ENTRIES)
    singles = written(singles, "singles")
    more = compared(singles, "strings", False)
    dropped(singles, starts)
    columns = ["doc", "version", "at", "n"]
    return found.where(F.col("kind") == COPY).select(columns).unionByName(more.where(F.col("kind") == COPY).select(columns))


def cut(raw: bytes, runs: np.ndarray | None) -> tuple[bytes, int, int]:
    """The bytes that stay, and how many were removed in how many runs. ``runs``: at << 32 | n of each."""
    if runs is None or not len(runs):
        return raw, 0, 0
    at, n = runs >> 32, runs & 0xFFFFFFFF
    size = len(raw) + 1
    edge = np.bincount(at, minlength=size) - np.bincount(at + n - 1 + LENGTH, minlength=size)
    gone = np.cumsum(edge)[:-1] > 0
    starts = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), starts


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, text, runs)."""
    for batch in batches:
        rows = []
        for text, runs in zip(batch.column(1), batch.column(2), strict=True):
            raw = (text.as_py() or "").encode()
            kept, removed, spans = cut(raw, runs.values.to_numpy() if runs.is_valid else None)
            rows.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], names=[c.split()[0] for c in SCHEMA.split(", ")])


def with_runs(docs: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, text, *keep) without repeated strings, and (doc_id, text, runs, *keep) that may have some; only the
    latter are shuffled."""
    spark = docs.sparkSession
    own = identified(docs, keep)
    runs = repeated_strings(own).groupBy("doc", "version").agg(F.collect_list(F.expr("shiftleft(cast(at AS long), 32) | cast(n AS long)")).alias("runs"))
    runs = written(runs, "runs")
    bloom = spark.sparkContext.broadcast(bloom_of(runs.select(_id_hash().alias("h"))))
    out = ["doc_id", "text", *(keep or [])]
    clean = own.where(_held(bloom, False)(_id_hash())).select(out)
    hit = own.where(_held(bloom, True)(_id_hash())).join(runs, ["doc", "version"], "left").select("doc_id", "text", "runs", *(keep or []))
    return clean, hit


def removal_digests(docs: DataFrame) -> DataFrame:
    clean, hit = with_runs(docs)
    text = F.coalesce("text", F.lit(""))
    whole = clean.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"))
    return whole.unionByName(hit.mapInArrow(_digests, SCHEMA))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, text, runs, ...): the text that stays; a character cut in the middle goes whole."""
    for batch in batches:
        out, removed = [], []
        for text, runs in zip(batch.column(1), batch.column(2), strict=True):
            kept, gone, _ = cut((text.as_py() or "").encode(), runs.values.to_numpy() if runs.is_valid else None)
            out.append(kept.decode("utf-8", "ignore") if text.is_valid else None)
            removed.append(gone)
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(removed, pa.int64()), *batch.columns[3:]], names=["doc_id", "text", "n_removed", *names[3:]])


def remaining_texts(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, text, n_removed, *keep) with the repeated bytes taken out."""
    clean, hit = with_runs(docs, keep)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in hit.schema.fields[3:]]
    cut_texts = hit.mapInArrow(_texts, ", ".join(["doc_id long, text string, n_removed long", *fields]))
    return clean.select("doc_id", "text", F.lit(0).cast("long").alias("n_removed"), *(keep or [])).unionByName(cut_texts)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(table(spark, sf_dir, "documents"))
