"""SentencePiece encoding and decoding through a table of distinct marked words.

A text is cut before every white-space marker that follows something else. Where no piece of the vocabulary holds a
marker after another character (checked when the model is loaded), no merge crosses such a cut, so the words of a text
are segmented alike wherever they stand. Each distinct word of the corpus is segmented once:

1. Every unit of documents (an input partition, cut each ``UNIT_BYTES`` of text) gives its distinct words.
2. (word, unit) rows meet by word, sorted; the word is segmented, and its ids go back to every unit that asked, packed
   into blocks. A word has one row a unit, so frequent words are no hot keys, and nothing is broadcast.
3. A unit's words are a folder of the shared table; the task that reads the unit's documents again loads it and joins
   ids back by position in the text.

The second scan has the units of the first where the input is read in the same partitions, as files are. A word that a
unit's folder lacks is segmented in place, so results don't rest on that; ``n_missed`` counts such places.

Memory of a task: the words of a unit in Arrow arrays with an index, some 100 bytes each, and the words of ``ROWS``
documents. A text without spaces is one word.
Units are at most ``UNIT_BYTES`` and one document large.

Decoding joins the ids' surfaces, read from the ids: markers become spaces, byte pieces bytes, and the space before the
first word goes. The end id has none.

Nulls: a null text is empty and has the end id only. A null id passes through; equal rows are encoded alike; an empty
table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import sentencepiece
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written_by
from .text_arrays import released

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: Bytes of text after which a partition opens a new unit.
UNIT_BYTES = 48 << 20
#: Words in an Arrow batch of the asking tasks, and documents whose words are joined at a time.
BATCH, ROWS = 1 << 15, 256
#: Rows (word, unit) that a segmenting task turns into blocks at a time.
HELD = 1 << 18
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_missed long"


class Pieces:
    """A model whose pieces don't cross white-space markers. Words are keyed without the one space that opens each."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in names):
            raise ValueError("a piece crosses a white-space marker")
        if self.model.encode("  a ", out_type=str)[-1] != MARK or self.model.decode(self.model.encode(" a ")) != " a ":
            raise ValueError("the model doesn't keep white space")
        self.end = self.model.eos_id()
        self.mark = self.model.piece_to_id(MARK)
        shown = [b"" if self.model.is_control(i) else bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.surface, self.decimal = pa.array(shown, pa.binary()), pa.array(map(str, range(len(names))), pa.string())

    def segmented(self, words: list[str]) -> list[list[int]]:
        """The model adds the opening marker itself, but to nothing it adds none."""
        return [ids or [self.mark] for ids in self.model.encode(words, num_threads=1)]

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids."""
        found = self.segmented(words)
        return np.fromiter(map(len, found), np.int32, len(found)), np.fromiter(chain.from_iterable(found), np.int32)

    def shown(self, counts: np.ndarray, flat: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Per word its decimal ids, and the surface of the ids without the opening space; both joined."""
        at, flat = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat)
        surface = pc.binary_join(pa.ListArray.from_arrays(at, self.surface.take(flat)), b"")
        decimal = pc.binary_join(pa.ListArray.from_arrays(at, self.decimal.take(flat)), " ")
        return decimal.cast(pa.large_string()), pc.binary_slice(surface, 1, 1 << 30).cast(pa.large_string())


@lru_cache(1)
def loaded(path: str) -> Pieces:
    return Pieces(path)


_runs = re.compile(" +[^ ]*").findall


def marked_words(text: str) -> list[str]:
    """The words of a text, each without the one space that opens it; more spaces stay before their word."""
    return [w[1:] for w in _runs(" " + text.replace(MARK, " "))] if text else []


def _units(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(unit, rows): the partition's number and how often ``most`` bytes of text were full before the rows."""
    part, seen = TaskContext.get().partitionId() << 20, 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        first, unit = 0, seen // most
        for k, size in enumerate(sizes):
            if seen // most != unit:
                if k > first:
                    yield part + unit, batch.slice(first, k - first)
                first, unit = k, seen // most
            seen += size
        yield part + unit, batch.slice(first)


def word_lists(texts: pa.Array) -> pa.LargeListArray:
    """The marked words of each text, none for a null or empty one. Texts whose words are all opened by one space are
    split as they are; the others one by one."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    odd = pc.or_(pc.match_substring(texts, MARK), pc.or_(pc.match_substring(texts, "  "), pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " "))))
    odd = pc.or_(odd, pc.equal(pc.binary_length(texts), 0))
    lists = pc.split_pattern(texts.filter(pc.invert(odd)), " ").cast(pa.large_list(pa.large_string()))
    if not pc.any(odd).as_py():
        return lists
    others = pa.array([marked_words(t) for t in texts.filter(odd).to_pylist()], pa.large_list(pa.large_string()))
    mask = odd.to_numpy(zero_copy_only=False)
    place = np.empty(len(texts), np.int64)
    place[~mask], place[mask] = np.arange(len(lists)), len(lists) + np.arange(len(others))
    return pa.concat_arrays([lists, others]).take(pa.array(place))


def asked(most: int):
    """For mapInArrow over (text): the distinct words of each unit."""

    def rows(unit: int, words: pa.Array) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(words), BATCH):
            part = words.slice(k, BATCH).cast(pa.string())
            yield pa.RecordBatch.from_arrays([part, pa.array(np.full(len(part), unit), pa.int64())], names=["word", "unit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, known = None, [], 0
        for unit, batch in _units(batches, 0, most):
            if unit != now and parts:
                yield from rows(now, pc.unique(pa.concat_arrays(parts)))
                parts, known = [], 0
            now = unit
            parts.append(pc.unique(pc.list_flatten(word_lists(batch.column(0)))))
            if sum(map(len, parts)) > 2 * known + 8 * BATCH:
                parts = [pc.unique(pa.concat_arrays(parts))]
                known = len(parts[0])
        if parts:
            yield from rows(now, pc.unique(pa.concat_arrays(parts)))
        del parts
        released()

    return run


def packed(words: pa.Array, counts: np.ndarray, flat: np.ndarray, units: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(unit, bytes unpacked, block): the words of each unit with their ids, as lengths, counts, ids and text."""
    order = np.argsort(units, kind="stable")
    words, units, ends = words.take(pa.array(order)), units[order], np.concatenate([[0], np.cumsum(counts)])
    counts = counts[order]
    flat = flat[np.repeat(ends[order] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())] if len(order) else flat
    ends = np.concatenate([[0], np.cumsum(counts)])
    offsets, text = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1], words.buffers()[2]
    cuts = np.flatnonzero(np.diff(units, prepend=units[:1] - 1, append=units[-1:] + 1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        parts = [np.int32([b - a]), np.diff(offsets[a : b + 1]), counts[a:b], flat[ends[a] : ends[b]]]
        raw = b"".join([*(x.astype(np.int32).tobytes() for x in parts), bytes(text[offsets[a] : offsets[b]]) if text else b""])
        yield int(units[a]), len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(size: int, block: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a block, their number of ids, and all ids."""
    raw = pa.decompress(block, size, codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int32, 1)[0])
    lengths, counts = np.frombuffer(raw, np.int32, n, 4), np.frombuffer(raw, np.int32, n, 4 + 4 * n)
    flat = np.frombuffer(raw, np.int32, counts.sum(), 4 + 8 * n)
    offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))
    return pa.LargeStringArray.from_buffers(n, offsets, pa.py_buffer(raw[4 + 8 * n + flat.nbytes :])), counts, flat


def segment(path: str):
    """For mapInArrow over (word, unit), equal words side by side: each word's ids, made once, in blocks by unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, last, held = loaded(path), (None, None), []

        def blocks() -> pa.RecordBatch:
            words, counts, ids, units = (list(x) for x in zip(*held, strict=True))
            rows = list(packed(pa.concat_arrays(words), np.concatenate(counts), np.concatenate(ids), np.concatenate(units)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _BLOCK_TYPES, strict=True)], names=["unit", "size", "block"])

        for batch in batches:
            runs = pc.dictionary_encode(batch.column(0))
            words, at = runs.dictionary.to_pylist(), runs.indices.to_numpy()
            kept = words[0] == last[0]
            counts, flat = codec.ids(words[kept:])
            if kept:
                counts, flat = np.concatenate([[len(last[1])], counts]).astype(np.int32), np.concatenate([last[1], flat])
            last = (words[-1], flat[len(flat) - counts[-1] :].copy())
            ends = np.cumsum(counts)
            many = counts[at]
            place = np.repeat(ends[at] - many - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            held.append((batch.column(0), many, flat[place], batch.column(1).to_numpy()))
            if sum(len(h[0]) for h in held) >= HELD:
                yield blocks()
        if held:
            yield blocks()
        released()

    return run


_BLOCK_TYPES = (pa.int64(), pa.int64(), pa.binary())


def word_table(docs: DataFrame, path: str, unit_bytes: int = UNIT_BYTES) -> str:
    """The folder of the table (unit, size, block), partitioned by unit; every distinct word is segmented once."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = docs.select("text").mapInArrow(asked(unit_bytes), "word string, unit long").repartition(n, "word").sortWithinPartitions("word")
    made = words.mapInArrow(segment(path), "unit long, size long, block binary")
    return written_by(made.repartition(n, "unit"), "pieces", "unit")


class UnitWords:
    """The words of one unit, from its folder; one that isn't there is segmented, and counted."""

    def __init__(self, folder: str, unit: int, codec: Pieces):
        self.codec, self.missed = codec, 0
        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")
        where, blocks = f"{root}/unit={unit}", []
        if store.get_file_info(where).type != fs.FileType.NotFound:
            for batch in ds.dataset(where, filesystem=store, format="parquet").to_batches(columns=["size", "block"]):
                blocks += map(unpacked, batch.column(0).to_pylist(), batch.column(1).to_pylist())
        self.word = pa.concat_arrays([b[0] for b in blocks]) if blocks else pa.array([], pa.large_string())
        self.ids, self.shown = codec.shown(*(np.concatenate([np.int32([]), *(b[k] for b in blocks)]).astype(np.int32) for k in (1, 2)))

    def texts(self, lists: pa.LargeListArray) -> tuple[pa.Array, pa.Array]:
        """Per list of words the ids and the surfaces, joined by spaces."""
        words = pc.list_flatten(lists)
        at = pc.index_in(words, self.word)
        ids, shown = self.ids, self.shown
        if at.null_count:
            lost = pc.is_null(at)
            rest = pc.dictionary_encode(words.filter(lost))
            self.missed += len(rest)
            ids, shown = (pa.concat_arrays(pair) for pair in zip((ids, shown), self.codec.shown(*self.codec.ids(rest.dictionary.to_pylist())), strict=True))
            place = at.to_numpy(zero_copy_only=False)
            place[np.isnan(place)] = len(self.word) + rest.indices.to_numpy()
            at = pa.array(place.astype(np.int64))
        join = lambda x: pc.binary_join(pa.LargeListArray.from_arrays(lists.offsets, x.take(at)), pa.scalar(" ", pa.large_string()))
        return join(ids), join(shown)


def _by_unit(batches: Iterator[pa.RecordBatch], codec: Pieces, folder: str, most: int) -> Iterator[tuple[pa.Array, pa.Array, pa.Array, int]]:
    """(doc_ids, ids with the end id, decoded texts, words that were missing) of bounded pieces of the batches."""
    now, words = None, None
    end = pa.scalar(str(codec.end), pa.large_string())
    for unit, batch in _units(batches, 1, most):
        if unit != now:
            words = None
            now, words = unit, UnitWords(folder, unit, codec)
        for k in range(0, len(batch), ROWS):
            part, before = batch.slice(k, ROWS), words.missed
            lists = word_lists(part.column(1))
            lists = pa.LargeListArray.from_arrays(pc.subtract(lists.offsets, lists.offsets[0]), pc.list_flatten(lists))
            ids, shown = words.texts(lists)
            yield part.column(0), pc.if_else(pc.equal(ids, ""), end, pc.binary_join_element_wise(ids, end, pa.scalar(" ", pa.large_string()))), shown, words.missed - before


def _sha(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t.as_buffer() or b"").hexdigest() for t in texts.cast(pa.large_binary())], pa.string())


def joined(path: str, folder: str, most: int):
    """For mapInArrow over (doc_id, text): digests of ids and of what they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids, shown, missed in _by_unit(batches, loaded(path), folder, most):
            counts = pc.add(pc.count_substring(ids, " "), 1).cast(pa.int64())
            lost = pa.array([missed] + [0] * (len(ids) - 1), pa.int64())
            yield pa.RecordBatch.from_arrays([doc_ids, counts, _sha(ids), _sha(shown), lost], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_missed"])
        released()

    return run


def pieces(docs: DataFrame, path: str, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Per document its number of ids with the end id, the digest of the ids joined by spaces, and of the decoded text."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(joined(path, word_table(rows, path, unit_bytes), unit_bytes), SCHEMA)


def token_ids(docs: DataFrame, path: str, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """(doc_id, ids) through the same table of words."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    folder = word_table(rows, path, unit_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, ids, _, _ in _by_unit(batches, loaded(path), folder, unit_bytes):
            lists = pc.split_pattern(ids, " ")
            yield pa.RecordBatch.from_arrays([doc_ids, lists.cast(pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)).drop("n_missed")
