"""Token ids in patched frame-of-reference blocks, written to files in ascending document order and read back.

Documents are range-partitioned by id, encoded in order, and packed into files of about ``IMAGE_TOKENS`` ids in the
shared folder. A block of 1,024 ids stores its minimum, then the differences packed at the width that holds
``PERCENTILE`` of them; the high bits of the few wider ones go to an exception list. Block starts are indexed, so one
block is read without the others. Each task names its files anew and returns their names; Spark's commit of that list is
the files' commit, so what a lost or repeated task leaves behind is in no list and never read.

Words and their pieces are looked up by 64-bit hash in a sorted table of those seen in the task (at most
``KNOWN_WORDS``); the tokenizer runs for new ones only.

Nulls: a null text is empty (the end id alone); null ids sort first and come back null. Equal ids are ordered by a hash
of the text. A text is tokenised whole, so a task needs memory for the longest one. An empty table gives no file and an
empty result. Extra columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text_arrays as ta
from .common import shared_dir, table, written

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BLOCK = 1024
PERCENTILE = 0.95
IMAGE_TOKENS = 1 << 20
#: Words, and ids of words, that a task keeps at most.
KNOWN_WORDS, KNOWN_IDS = 1 << 19, 1 << 21
_TOP_BITS = 19
MAGIC = b"PFORv2\0\0"
FILES = "part int, seq int, n_docs int, n_tokens long, path string"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"
_LANES = 32


@lru_cache(1)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Classes of bytes: letters, symbols, digits; 0 for what only the tokenizer tells.
_LETTER, _SYMBOL, _DIGIT = 1, 2, 3
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _SYMBOL
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _CLASS[0xC3:0xCA] = _LETTER
_CLASS[[0x27, 0x3C]] = 0  # contractions, special tokens


def _pieces(t: ta.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and starts and ends of the pieces that are tokenised by themselves.

    The tokenizer lower-cases and splits at every change between letters, symbols and single digits. Words of ASCII and of
    Latin letters of two bytes are split here, as their classes show in the bytes; other words stay whole and as they are.
    """
    data, inside = t.data, ~ta.SPACE[t.data]
    kind = _CLASS[data]
    after = np.zeros(len(data), np.uint8)
    after[1:] = data[:-1]
    second = (data >= 0x80) & (data < 0xC0) & (after >= 0xC3) & (after < 0xCA)
    second &= ~((after == 0xC3) & ((data == 0x97) | (data == 0xB7)))  # the signs for times and divided by
    kind[second] = _LETTER
    starts, ends = t.spans(inside)
    odd = np.concatenate(([0], np.cumsum(kind == 0, dtype=np.int64)))
    plain = np.zeros(len(data) + 1, np.int8)
    chosen = odd[ends] == odd[starts]
    plain[starts[chosen]] += 1
    plain[ends[chosen]] -= 1
    plain = np.cumsum(plain[:-1], dtype=np.int8) > 0
    lowered = np.where(second & (after == 0xC3) & (data < 0x9F), data + 0x20, ta.LOWER[data])
    opens = np.zeros(len(data), bool)
    opens[1:] = plain[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    opens[starts] = True
    closes = np.zeros(len(data), bool)
    closes[:-1] = opens[1:] & inside[:-1]
    closes[ends - 1] = True
    return np.where(plain, lowered, data).astype(np.uint8), np.flatnonzero(opens), np.flatnonzero(closes) + 1


class Words:
    """Ids of words (runs without ASCII white space) and their pieces. The tokenizer's normaliser and splitter never join
    text across ASCII white space, so a text's ids are its words' ids in order."""

    def __init__(self, path: str, known_words: int = KNOWN_WORDS, known_ids: int = KNOWN_IDS):
        self.tokenizer, self.known_words, self.known_ids = _tokenizer(path), known_words, known_ids
        self._clear()

    def _clear(self) -> None:
        self.keys, self.starts, self.sizes, self.ids = np.zeros(0, ta.U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")
        self._index()

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash stands in the table, and whether it does: by its top bits, then along the few keys that share them."""
        top = (hashes >> ta.U64(64 - _TOP_BITS)).astype(np.int64)
        at, end = self.first[top], self.first[top + 1]
        known = np.zeros(len(hashes), bool)
        left = np.flatnonzero(at < end)
        while len(left):
            hit = self.keys[at[left]] == hashes[left]
            known[left[hit]] = True
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return at, known

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        keys, starts = np.concatenate((self.keys, hashes)), np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        sizes, self.ids = np.concatenate((self.sizes, sizes)), np.concatenate((self.ids, np.array([i for x in found for i in x], "<u4")))
        order = np.argsort(keys)
        self.keys, self.starts, self.sizes = keys[order], starts[order], sizes[order]
        self._index()

    def _index(self) -> None:
        counts = np.bincount((self.keys >> ta.U64(64 - _TOP_BITS)).astype(np.int64), minlength=1 << _TOP_BITS)
        self.first = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)

    def encoded(self, t: ta.Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by ``end_id``; and how many each text has, with it."""
        data, starts, ends = _pieces(t)
        docs = t.doc_of(starts)
        hashes = ta.Texts(t.first, t.last, data, t.offsets).hashes(starts, ends)
        at, known = self._find(hashes)
        if not known.all():
            if len(self.keys) > self.known_words or len(self.ids) > self.known_ids:
                self._clear()
                known[:] = False
            unknown = np.flatnonzero(~known)
            new, first = np.unique(hashes[unknown], return_index=True)
            first, raw = unknown[first], data.tobytes()
            self._learn(new, [raw[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
            at, _ = self._find(hashes)
        sizes = self.sizes[at]
        rest = np.arange(sizes.sum())
        ids = np.full(len(rest) + t.count, end_id, "<u4")
        ids[rest + np.repeat(docs, sizes)] = self.ids[rest + np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes)]
        return ids, np.bincount(docs, sizes, t.count).astype(np.int64) + 1


def _bits(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) values below 2**width as (blocks, width, lanes) words; value r of a lane starts at bit r*width."""
    cube = rows.reshape(-1, BLOCK // _LANES, _LANES)
    out = np.zeros((len(cube), width, _LANES), np.uint32)
    for r in range(BLOCK // _LANES if width else 0):
        word, shift = divmod(r * width, 32)
        out[:, word] |= cube[:, r] << np.uint32(shift)
        if shift + width > 32:
            out[:, word + 1] |= cube[:, r] >> np.uint32(32 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    cube = np.zeros((len(words), BLOCK // _LANES, _LANES), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for r in range(BLOCK // _LANES if width else 0):
        word, shift = divmod(r * width, 32)
        value = words[:, word] >> np.uint32(shift)
        if shift + width > 32:
            value = value | (words[:, word + 1] << np.uint32(32 - shift))
        cube[:, r] = value & mask
    return cube.reshape(-1, BLOCK)


def encode_image(doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray, n_null: int = 0) -> bytes:
    """One file: header, document index, block index, blocks. ``starts`` has one more entry than there are documents; the
    first ``n_null`` of these have no id."""
    n_blocks = -(-len(ids) // BLOCK)
    rows = np.zeros(n_blocks * BLOCK, np.uint32)
    rows[: len(ids)] = ids
    if len(ids):
        rows[len(ids) :] = ids[-1]
    rows = rows.reshape(n_blocks, BLOCK)
    mins = rows.min(axis=1) if n_blocks else np.zeros(0, np.uint32)
    rows = rows - mins[:, None]
    at = int(np.ceil(PERCENTILE * BLOCK)) - 1
    widths = _bits(np.partition(rows, at, axis=1)[:, at]) if n_blocks else np.zeros(0, np.int64)
    outlier = (rows >> widths[:, None].astype(np.uint32)) > 0
    counts = outlier.sum(axis=1)
    packed: list[bytes] = [b""] * n_blocks
    for w in np.unique(widths):
        chosen = np.flatnonzero(widths == w)
        words = _pack(rows[chosen] & np.uint32((1 << int(w)) - 1), int(w)).astype("<u4")
        for k, b in enumerate(chosen):
            packed[b] = words[k].tobytes()
    block_of, place = np.nonzero(outlier)
    high = (rows[block_of, place] >> widths[block_of].astype(np.uint32)).astype("<u4")
    place = place.astype("<u2")
    edges = np.concatenate(([0], np.cumsum(counts)))
    blocks = [packed[b] + place[edges[b] : edges[b + 1]].tobytes() + high[edges[b] : edges[b + 1]].tobytes() for b in range(n_blocks)]
    block_starts = np.concatenate(([0], np.cumsum([len(b) for b in blocks], dtype=np.int64)))
    head = np.array([len(doc_ids), len(ids), n_blocks, BLOCK, n_null, 0], "<u4").tobytes()
    return b"".join((MAGIC, head, doc_ids.astype("<i8").tobytes(), starts.astype("<u4").tobytes(), mins.astype("<u4").tobytes(), widths.astype("u1").tobytes(), counts.astype("<u2").tobytes(), block_starts.astype("<u4").tobytes(), *blocks))


class Image:
    """A file read back; ``block(k)`` decodes one block by the index, ``ids()`` all of them."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a file of this format")
        n_docs, self.n, self.n_blocks, size, self.n_null, _ = np.frombuffer(raw, "<u4", 6, 8).tolist()
        if size != BLOCK:
            raise ValueError(f"block size {size}")
        at, self.raw = 32, raw
        for name, kind, n in (("doc_ids", "<i8", n_docs), ("starts", "<u4", n_docs + 1), ("mins", "<u4", self.n_blocks), ("widths", "u1", self.n_blocks), ("counts", "<u2", self.n_blocks), ("block_starts", "<u4", self.n_blocks + 1)):
            setattr(self, name, np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.at = at

    def _patched(self, chosen: np.ndarray, w: int) -> np.ndarray:
        size = w * _LANES
        at = self.at + self.block_starts[chosen].astype(np.int64)
        words = np.stack([np.frombuffer(self.raw, "<u4", size, a) for a in at.tolist()]).reshape(len(chosen), w, _LANES)
        rows = _unpack(words, w)
        for k, (a, n) in enumerate(zip(at.tolist(), self.counts[chosen].tolist(), strict=True)):
            if n:
                place = np.frombuffer(self.raw, "<u2", n, a + 4 * size)
                rows[k, place] |= np.frombuffer(self.raw, "<u4", n, a + 4 * size + 2 * n) << np.uint32(w)
        return rows + self.mins[chosen][:, None]

    def block(self, k: int) -> np.ndarray:
        return self._patched(np.array([k]), int(self.widths[k]))[0][: self.n - k * BLOCK]

    def ids(self) -> np.ndarray:
        out = np.empty((self.n_blocks, BLOCK), np.uint32)
        for w in np.unique(self.widths):
            chosen = np.flatnonzero(self.widths == w)
            out[chosen] = self._patched(chosen, int(w))
        return out.reshape(-1)[: self.n]


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder, by its URI."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")


def _filed(path: str, end_id: int, folder: str):
    """For mapInArrow over (doc_id, text) in order: writes the files of a partition and yields a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, words = TaskContext.get().partitionId(), 0, Words(path)
        doc_ids: list[pa.Array] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def filed() -> pa.RecordBatch:
            keys = pa.concat_arrays(doc_ids)
            starts = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
            store, at = _store(folder)
            name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}.pfor"
            with store.open_output_stream(f"{at}/{name}") as out:
                out.write(encode_image(keys.fill_null(0).to_numpy(), starts, np.concatenate(ids), keys.null_count))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(keys)], pa.int32()), pa.array([int(starts[-1])], pa.int64()), pa.array([f"{folder}/{name}"])], names=["part", "seq", "n_docs", "n_tokens", "path"])

        for batch in batches:
            for t in ta.slices(batch.column(1)):
                own, n = words.encoded(t, end_id)
                doc_ids.append(batch.column(0).slice(t.first, t.count))
                ids.append(own)
                sizes.append(n)
                if sum(map(len, ids)) >= IMAGE_TOKENS:
                    yield filed()
                    seq, doc_ids, ids, sizes = seq + 1, [], [], []
        if ids:
            yield filed()
        del words, ids, doc_ids, sizes
        ta.released()

    return run


def write_files(docs: DataFrame, path: str, end_id: int = END_ID, partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """Encodes (doc_id, text) into files in ``folder`` (one that all executors see; by default in the shared folder).

    Returns the list of files, one row each, as a written table.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    store, at = _store(folder)
    store.create_dir(at)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(n, *order).sortWithinPartitions(*order)
    return written(rows.mapInArrow(_filed(path, end_id, folder), FILES), "token-files")


def with_starts(files: DataFrame) -> DataFrame:
    """Adds the number of ids in all files before each: sums per partition (one row each) and a window within one."""
    totals = sorted((r[0], r[1]) for r in files.groupBy("part").agg(F.sum("n_tokens")).collect())
    starts, seen = [], 0
    for part, n in totals:
        starts.append((part, seen))
        seen += n
    before = files.sparkSession.createDataFrame(starts, "part int, before long")
    order = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inner = files.withColumn("inner", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    return inner.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("inner")).drop("before", "inner")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (start, path)."""
    for batch in batches:
        for start, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            store, at = _store(path)
            with store.open_input_stream(at) as raw:
                image = Image(raw.read())
            ids, edges = image.ids().astype("<u4"), image.starts.astype(np.int64)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            no_id = np.arange(len(edges) - 1) < image.n_null
            yield pa.RecordBatch.from_arrays([pa.array(image.doc_ids, mask=no_id), pa.array(start + edges[:-1]), pa.array(np.diff(edges)), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(files: DataFrame) -> DataFrame:
    """Per document its place, length and checksum, decoded from the files."""
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_starts(files).select("start", "path").repartition(n).mapInArrow(_read, DOCS)


def op7_patched_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(write_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)))
