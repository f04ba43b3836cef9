"""Benchmark decontamination: documents that hold a benchmark item up to a few edits.

Texts and items are compared as normalised bytes: A-Z lower-cased, every run of ASCII other than letters and digits as one
space. An item of m bytes allows ``floor(MAX_EDITS * m)`` edits (fewer where an item is so short that ``GRAM`` bytes times
that number would use it up).

1. Windows. A place with e edits against an item still shares at least ``m - GRAM + 1 - GRAM * e`` of its grams (q-gram
   lemma), nearly all on a few diagonals (text place minus item place). Item-sized windows are opened where the grams of
   a document reach that count for some item of that size; the lemma loses nothing. Grams that many items
   share are counted ``EXPANDED`` places at a time.
2. Embedding. Windows and items take the CGK random walk (Chakraborty, Goldenberg, Koucky 2016): a cursor advances or
   stays by a shared random bit per step and byte, so edit distance becomes Hamming distance. Each of several walks
   samples ``SAMPLED`` places, while both cursors are inside, as an LSH key; a window's candidates are the items, of all
   those of its size, that have one of its keys. How many walks there are follows from ``RECALL`` and from the share of
   equal places that is measured, for items of about that size, at the number of edits allowed.
3. Verification. The exact least edit distance between the item and any substring around the window (bit-parallel
   dynamic programming).

The benchmark is broadcast in blocks of ``BLOCK_ITEMS``, one pass over the documents each, so its size is bounded.

Nulls: null texts and null or blank items match nothing. Items shorter than two grams
allow no edits, and those shorter than one gram are looked up as whole words. A null doc_id comes back null. Repeated
items or rows are reported once each by id. A text or an item is held whole by a task; walks need no tables, so very long
ones cost time in proportion. Empty tables give an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text_arrays as ta
from .common import table

GRAM = 8
MAX_EDITS = 0.1
SAMPLED = 3
RECALL = 0.99
#: Places are sampled in this share of twice the item's length, where a cursor ends on average.
SAMPLED_SPAN = 0.9
#: Pairs of an item and an edited copy by which the share of equal places of a size is measured.
MEASURED_PAIRS = 24
#: (Text place, item place) pairs of equal grams that are held at a time.
EXPANDED = 1 << 20
#: Walks of a size at most; sizes that would need more are all verified.
MOST_WALKS = 256
BLOCK_ITEMS = 5000
SCHEMA = "doc_id long, item_id long, distance int, item_bytes int"

_TABLE_BITS = 22
_KEEP = np.zeros(256, bool)
_KEEP[48:58] = _KEEP[97:123] = _KEEP[128:] = True
_FOLD = np.where(_KEEP, np.arange(256), 32).astype(np.uint8)


def normalised(t: ta.Texts) -> ta.Texts:
    """Of lower-cased texts: other ASCII runs to one space, none at the start of a document."""
    data = _FOLD[t.data]
    space = data == 32
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    edges = t.offsets[:-1][t.offsets[:-1] < len(data)]
    before[edges] = True
    keep = ~(space & before)
    return ta.Texts(t.first, t.last, data[keep], np.concatenate(([0], np.cumsum(keep)))[t.offsets])


def normalised_text(text: str) -> bytes:
    for t in ta.slices(pa.array([text]), lower=True):
        return normalised(t).data.tobytes().rstrip(b" ")
    return b""


def _grams(data: np.ndarray) -> np.ndarray:
    """The ``GRAM`` (8) bytes from each place as one integer."""
    n = max(len(data) - GRAM + 1, 0)
    out = np.zeros(n, ta.U64)
    for k in range(GRAM):
        out |= data[k : k + n].astype(ta.U64) << ta.U64(8 * k)
    return out


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * ta._STEP) >> ta.U64(64 - _TABLE_BITS)


def edits_within(item: bytes, text: bytes, most: int) -> int | None:
    """The least edit distance between ``item`` and a substring of ``text``, if it is at most ``most`` (Myers 1999)."""
    m = len(item)
    masks: dict[int, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in text:
        eq = masks[c] if c in masks else 0
        x = eq | minus
        d0 = ((((x & plus) + plus) ^ plus) | x) & full
        up, down = (minus | ~(d0 | plus)) & full, d0 & plus
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full
        plus, minus = (((down << 1) & full) | (~(d0 | up) & full)), d0 & up
        if score < best:
            best = score
    return best if best <= most else None


class Benchmark:
    """A block of items, their grams indexed by hash slot, and their LSH keys."""

    def __init__(self, items: list[tuple[int, str]], seed: int = 7):
        self.ids, self.items = [], []
        for item_id, text in items:
            item = normalised_text(text or "")
            if item:
                self.ids.append(item_id)
                self.items.append(item)
        sizes = np.array([len(x) for x in self.items], np.int64)
        self.sizes = sizes
        self.edits = np.clip((sizes - GRAM) // GRAM, 0, (MAX_EDITS * sizes).astype(np.int64))
        self.edits[sizes < 2 * GRAM] = 0
        self.needed = np.maximum(sizes - GRAM + 1 - GRAM * self.edits, 1)
        grams = [_grams(np.frombuffer(x, np.uint8)) for x in self.items]
        self.gram = np.concatenate(grams) if grams else np.zeros(0, ta.U64)
        self.gram_item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        self.gram_place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(self.gram, kind="stable")
        self.gram, self.gram_item, self.gram_place = self.gram[order], self.gram_item[order], self.gram_place[order]
        self.present = np.zeros(1 << _TABLE_BITS, bool)
        self.present[_slot(self.gram)] = True
        self.seed, drawn = ta.U64(seed), np.random.Generator(np.random.PCG64(seed))
        self.bytes_at = drawn.integers(0, 1 << 63, 257, dtype=ta.U64)
        self.fractions = drawn.random((MOST_WALKS, SAMPLED))
        self.classes = np.log2(np.maximum(sizes, 1)).astype(np.int64)
        self.walks = {int(c): self._walks_needed(np.flatnonzero(self.classes == c), drawn) for c in np.unique(self.classes)}
        keys, owners = [], []
        for k, item in enumerate(self.items):
            own = self.keys([np.frombuffer(item, np.uint8)], int(sizes[k]), self.walks[int(self.classes[k])])[0]
            keys.append(own)
            owners.append(np.full(len(own), k))
        every, owner = (np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((keys, ta.U64), (owners, np.int64)))
        order = np.argsort(every, kind="stable")
        self.item_keys, self.key_item = every[order], owner[order]

    def _steps(self, size: int) -> int:
        return max(1, int(SAMPLED_SPAN * 2 * size))

    def embedded(self, windows: list[np.ndarray], size: int, walks: int, places: np.ndarray) -> np.ndarray:
        """(windows, walks, SAMPLED) bytes that the cursors show at the sampled steps; 256 behind a window's end."""
        n, width = len(windows), size
        text = np.full((n, width + 1), 256, np.int64)
        for k, w in enumerate(windows):
            text[k, : min(len(w), width)] = w[:width]
        out = np.zeros((n, walks, places.shape[1]), np.int64)
        cursor, rows = np.zeros((n, walks), np.int64), np.arange(n)[:, None]
        wanted: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for r, j in np.ndindex(walks, places.shape[1]):
            wanted[int(places[r, j])].append((r, j))
        walk_ids = np.arange(walks, dtype=ta.U64) + self.seed * ta.U64(1 << 20)
        for step in range(int(places.max()) + 1):
            byte = text[rows, np.minimum(cursor, width)]
            for r, j in wanted.get(step, ()):
                out[:, r, j] = byte[:, r]
            bits = ta.mixed(walk_ids + np.full(1, step, ta.U64) * ta._STEP)  # one of 64 random bits each, picked by the byte
            cursor += ((bits[None] ^ self.bytes_at[byte]) * ta._STEP >> ta.U64(63)).astype(np.int64)
        return out

    def places(self, size: int, walks: int) -> np.ndarray:
        return (self.fractions[:walks] * self._steps(size)).astype(np.int64)

    def keys(self, windows: list[np.ndarray], size: int, walks: int) -> np.ndarray:
        """(windows, walks) keys, told apart by the walk and by the size of the items they are for."""
        shown = self.embedded(windows, size, walks, self.places(size, walks))
        salt = np.arange(walks, dtype=ta.U64) * ta._GRAM[50] + np.full(1, size, ta.U64) * ta._GRAM[51]
        key = np.zeros(shown.shape[:2], ta.U64)
        for j in range(SAMPLED):
            key += ta.mixed((shown[:, :, j] + 257 * j + 1).astype(ta.U64))
        return ta.mixed(key + salt[None])

    def _walks_needed(self, items: np.ndarray, drawn: np.random.Generator) -> int:
        """Walks for items of about one size: by the share of equal places that nine of ten edited copies keep."""
        shares = []
        for k in np.resize(items, min(MEASURED_PAIRS, 8 * len(items))).tolist():
            item = np.frombuffer(self.items[k], np.uint8)
            pieces = [bytes([c]) for c in item]
            for at in drawn.choice(len(item), int(self.edits[k]), replace=False).tolist():
                pieces[at] = (b"", b"\x01", pieces[at] + b"\x01")[int(drawn.integers(3))]
            copy = np.frombuffer(b"".join(pieces), np.uint8)
            at = np.tile(np.linspace(0, self._steps(len(item)) - 1, 48).astype(np.int64), (16, 1))
            one, two = self.embedded([item, copy], len(item), 16, at)
            shares.append(float(np.mean(one == two)))
        share = float(np.quantile(shares, 0.1)) if shares else 1.0
        hit = min(max(share, 0.05) ** SAMPLED, 1 - 1e-9)
        return int(np.clip(math.ceil(math.log(1 - RECALL) / math.log(1 - hit)), 4, MOST_WALKS))

    def windows(self, t: ta.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, start in the data) of the windows to look at."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        grams = _grams(t.data)
        at = np.flatnonzero(self.present[_slot(grams)])
        low = np.searchsorted(self.gram, grams[at])
        count = np.searchsorted(self.gram, grams[at], side="right") - low
        docs = t.doc_of(at)
        inside = (count > 0) & (at + GRAM <= t.offsets[docs + 1])
        at, low, count, docs = at[inside], low[inside], count[inside], docs[inside]
        if not len(at):
            return none
        parts = np.cumsum(count) // EXPANDED
        edges = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1], True])

        def expanded(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
            """Which of the text places a to b, and the entry of an item's gram, for every pair of equal grams."""
            n = count[a:b]
            return np.repeat(np.arange(a, b), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[a:b], n)

        pairs, times = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            k, each = expanded(a, b)
            found = np.unique(docs[k] * len(self.items) + self.gram_item[each], return_counts=True)
            pairs.append(found[0])
            times.append(found[1])
        pair, back = np.unique(np.concatenate(pairs), return_inverse=True)
        pair = pair[np.bincount(back, np.concatenate(times)) >= self.needed[pair % len(self.items)]]
        if not len(pair):
            return none
        kept = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            k, each = expanded(a, b)
            own = docs[k] * len(self.items) + self.gram_item[each]
            there = pair[np.minimum(np.searchsorted(pair, own), len(pair) - 1)] == own
            kept.append((k[there], each[there]))
        k, each = (np.concatenate(x) for x in zip(*kept, strict=True))
        at, docs, item, place = at[k], docs[k], self.gram_item[each], self.gram_place[each]
        start, need = at - place, self.needed[item]
        room = 2 * (int(self.edits.max()) + 1)
        out = []
        for shift in (0, room // 2):
            key = (item * (t.count + 1) + docs) * (len(t.data) // room + 16) + (start + shift + 4 * room) // room
            slot = (ta.mixed(key.astype(ta.U64)) >> ta.U64(44)).astype(np.int64)  # keys that share a slot only add up
            near = np.flatnonzero(np.bincount(slot)[slot] >= need)
            groups, back = np.unique(key[near], return_inverse=True)
            # shared grams are at most the text places, and at most the item places, that take part
            parts = [np.unique(back * (int(x.max()) + 1) + x) // (int(x.max()) + 1) for x in (at[near], place[near]) if len(x)]
            if parts:
                votes = np.minimum(*(np.bincount(x, minlength=len(groups)) for x in parts))
                good = near[votes[back] >= need[near]]
                out.append(np.stack((docs[good], item[good], start[good])))
        if not out:
            return none
        spots, times = np.unique(np.concatenate(out, axis=1), axis=1, return_counts=True)
        # edits cut the shared grams into edits + 1 diagonals at most; a diagonal is seen in one bucketing or both
        item = spots[1]
        return tuple(spots[:, times >= -(-self.needed[item] // (self.edits[item] + 1))])

    def words(self, t: ta.Texts) -> dict[tuple[int, int], int]:
        """(document, item) of the items shorter than a gram that stand in a document as whole words."""
        out = {}
        text = t.data.tobytes()
        for i in np.flatnonzero(self.sizes < GRAM).tolist():
            at = text.find(self.items[i])
            while at >= 0:
                d, end = int(t.doc_of(np.array([at]))[0]), at + len(self.items[i])
                if end <= t.offsets[d + 1] and (at == t.offsets[d] or text[at - 1] == 32) and (end == t.offsets[d + 1] or text[end] == 32):
                    out[d, i] = 0
                at = text.find(self.items[i], at + 1)
        return out

    def found(self, t: ta.Texts) -> dict[tuple[int, int], int]:
        """The least distance of each (document, item) within its edits."""
        out = self.words(t)
        docs, items, starts = self.windows(t)
        if not len(docs):
            return out
        sizes = self.sizes[items]
        opened = np.unique(np.stack((sizes, docs, starts)), axis=1)  # windows, whichever item opened them
        candidates: dict[tuple[int, int], list[int]] = defaultdict(list)
        for size in np.unique(opened[0]).tolist():
            chosen = opened[:, opened[0] == size]
            for d, i, start in self._candidates(t, size, chosen[1], chosen[2]):
                candidates[d, i].append(start)
        for (d, i), near in candidates.items():
            e, first, last = int(self.edits[i]), int(t.offsets[d]), int(t.offsets[d + 1])
            regions: list[list[int]] = []  # windows that overlap are compared as one
            for start in sorted(near):
                a, b = max(start - e, first), min(start + int(self.sizes[i]) + e, last)
                if regions and a <= regions[-1][1]:
                    regions[-1][1] = max(b, regions[-1][1])
                else:
                    regions.append([a, b])
            for a, b in regions:
                around = t.data[a:b].tobytes()
                distance = 0 if self.items[i] in around else edits_within(self.items[i], around, e)
                if distance is not None:
                    out[d, i] = min(distance, out.get((d, i), e))
        return out

    def _candidates(self, t: ta.Texts, size: int, docs: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, item, start) of windows of one size and the items that have one of their keys."""
        walks = self.walks[int(math.log2(max(size, 1)))]
        same = np.flatnonzero(self.sizes == size)
        for a in range(0, len(docs), 1024):
            d, s = docs[a : a + 1024], starts[a : a + 1024]
            if walks >= MOST_WALKS:
                windows, items = np.repeat(np.arange(len(d)), len(same)), np.tile(same, len(d))
            else:
                first, last = np.maximum(s, t.offsets[d]), np.minimum(s + size, t.offsets[d + 1])
                keys = self.keys([t.data[x:y] for x, y in zip(first.tolist(), last.tolist(), strict=True)], size, walks).ravel()
                low, high = np.searchsorted(self.item_keys, keys), np.searchsorted(self.item_keys, keys, side="right")
                count = high - low
                each = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                pairs = np.unique(np.stack((np.repeat(np.arange(len(keys)) // walks, count), self.key_item[each])), axis=1)
                windows, items = pairs
            for w, i in zip(windows.tolist(), items.tolist(), strict=True):
                yield int(d[w]), i, int(s[w])


def searched(bench: Benchmark):
    """For mapInArrow over (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in ta.slices(batch.column(1), lower=True):
                for (d, i), distance in bench.found(normalised(t)).items():
                    rows.append((batch.column(0)[t.first + d].as_py(), bench.ids[i], distance, len(bench.items[i])))
            cols = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "item_id", "distance", "item_bytes"])

    return run


def _blocks(benchmark: DataFrame, block: int) -> Iterator:
    """The items as broadcast blocks of about ``block``."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL")
    blocks = max(1, math.ceil(items.count() / block))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text")
        yield spark.sparkContext.broadcast(Benchmark([(r.item_id, r.text) for r in part.collect()]))


def leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id, distance, item_bytes) of every item found in a document."""
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return reduce(DataFrame.unionByName, (texts.mapInArrow(_with_broadcast(bench), SCHEMA) for bench in _blocks(benchmark, block)))


def _clean(bench):
    """A function of a text Column: whether the text holds none of the block's items."""

    @F.arrow_udf("boolean")
    def run(texts: pa.Array) -> pa.Array:
        good = np.ones(len(texts), bool)
        for t in ta.slices(texts, lower=True):
            if bench.value.items:
                good[[t.first + d for d, _ in bench.value.found(normalised(t))]] = False
        return pa.array(good)

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """The rows, with all their columns, that hold no item; only texts go to Python."""
    for bench in _blocks(benchmark, block):
        docs = docs.where(_clean(bench)("text"))
    return docs


def _with_broadcast(bench):
    """For mapInArrow over (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if bench.value.items:
            yield from searched(bench.value)(batches)

    return run


def leaking_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document that holds an item: how many, which, and the least distance."""
    found = leaks(docs, benchmark).groupBy("doc_id")
    return found.agg(F.countDistinct("item_id").alias("n_items"), F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.min("distance").alias("least_distance"))


def op6_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaking_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
