"""Byte-level BPE by backtracking over longest matches, and decoding.

Token byte strings are read as Latin-1 text, so one pyahocorasick automaton over characters finds every token in a
piece. Encoding walks left to right with the longest token at each place and steps back to shorter ones; a token may
follow another only if merging their joint bytes would give exactly these two, which a memoised check on the tokens'
own merges decides. A place from which no way leads on is marked once, so the work is linear in the piece and the
result is that of the merges.

A chunk (white space, then other characters) is encoded alike in any text, as every match of the splitting pattern ends
where white space begins after something else; chunks are memoised up to a bounded number.

A piece is matched ``WINDOW`` bytes at a time and its ids are held in arrays, so a very long piece takes some 20 bytes
of memory a byte; memos live as long as a worker
process and are bounded, to some 200 MB.

Nulls: a null text is empty (no ids). A null id passes through; equal rows are encoded alike; an empty table gives an
empty result. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .text_arrays import released

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Chunks and pieces that a process remembers, twice as many at most, and characters of each.
CACHED_CHUNKS, CACHED_PIECES = 1 << 18, 1 << 16
CACHED_LENGTH = 32
#: Pairs whose compatibility is remembered at most, and bytes of a piece that are matched at a time.
CACHED_PAIRS, WINDOW = 1 << 18, 1 << 14
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Unicode's White_Space, which Python's \s exceeds by U+001C to U+001F.
_SPACE = "\t-\r \x85\xa0  -     　"
_chunks = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+").findall


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _ranges(chars: set[str]) -> str:
    """A set of characters as the inside of a character class."""
    codes, out = sorted(map(ord, chars)), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def engine_classes(most: int) -> dict[str, str]:
    r"""What stands for \p{L}, \p{N} and \s in a pattern of the re module, for characters up to ``most``: the classes as
    tiktoken's engine has them, whatever Unicode version it knows."""
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, most + 1)]))
    single = {bytes([i]): i for i in range(256)}
    found = {r"\s": _SPACE}
    for name in "LN":
        keep = tiktoken.Encoding(name, pat_str=rf"\p{{{name}}}+", mergeable_ranks=single, special_tokens={})
        found[rf"\p{{{name}}}"] = _ranges(set(bytes(keep.encode_ordinary(everything)).decode()))
    return found


def splitter(pattern: str, most: int):
    """``pattern`` for the re module, which tests such classes by table; right for texts without characters over ``most``."""
    classes = engine_classes(most)
    out, inside, at = [], False, 0
    while at < len(pattern):
        name = next((k for k in (*classes, r"\S") if pattern.startswith(k, at)), None)
        if name == r"\S":
            out.append(f"[^{_SPACE}]")
        elif name:
            out.append(classes[name] if inside else f"[{classes[name]}]")
        else:
            inside = {"[": True, "]": False}.get(pattern[at], inside)
            out.append(pattern[at])
        at += len(name or " ")
    return re.compile("".join(out))


class BytePairs:
    """A vocabulary of ranks with its merges recovered: encodes and decodes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.ascii, self.plane, self.all = (splitter(pattern, most).findall for most in (0x7F, 0xFFFF, 0x10FFFF))
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.longest = max(map(len, ranks))
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.fits: dict[int, bool] = {}
        for rank, token in sorted(self.token.items()):
            self._learn(rank, token)
        self.fits.clear()

    def _learn(self, rank: int, token: bytes) -> None:
        """The last merge that makes a token: its longest first part whose pair is final among lower ranks."""
        for cut in range(len(token) - 1, 0, -1):
            left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
            if left is not None and right is not None and left < rank and right < rank and self._final(left, right):
                self.merged[left, right] = rank
                self.parts[rank] = (left, right)
                return
        self.parts[rank] = (rank, rank)

    def _final(self, left: int, right: int) -> bool:
        """Whether merging the joint bytes of two tokens gives these two.

        Undoes the later of the two merges again and again, and looks at the pair that then meets at the seam: were it
        to merge before the merge just undone, the seam would have closed.
        """
        pair = left << 32 | right
        known = self.fits.get(pair)
        if known is not None:
            return known
        a, b, before = left, right, 1 << 62
        while True:
            joint = self.merged.get((a, b))
            if joint is not None and joint < before:
                ok = False
                break
            inner = self.parts[a][1] if a > b else self.parts[b][0]
            if a > b:
                before, moved = a, inner != a
                a = inner
                if not moved:
                    before, inner = b + 1, self.parts[b][0]
                    if inner == b:
                        ok = True
                        break
                    b = inner
            else:
                before, moved = b + 1, inner != b
                b = inner
                if not moved:
                    before, inner = a, self.parts[a][1]
                    if inner == a:
                        ok = True
                        break
                    a = inner
        if len(self.fits) >= CACHED_PAIRS:
            self.fits.clear()
        self.fits[pair] = ok
        return ok

    def pieces(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text)
        return self.plane(text) if max(text) <= "\uffff" else self.all(text)

    def _found(self, piece: str, start: int) -> list[list[tuple[int, int]]]:
        """(rank, size) of the tokens at each of the ``WINDOW`` places from ``start`` on; sizes ascend."""
        part = piece[start : start + WINDOW + self.longest - 1]
        found: list[list[tuple[int, int]]] = [[] for _ in range(min(WINDOW, len(piece) - start))]
        for end, (rank, size) in self.automaton.iter(part):
            if end + 1 - size < WINDOW:
                found[end + 1 - size].append((rank, size))  # ends come in order
        return found

    def encode_piece(self, piece: bytes) -> Sequence[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, text = len(piece), piece.decode("latin-1")
        low, found = 0, self._found(text, 0)
        out, tried = array("i"), array("H")  # which of the tokens at its place each chosen one is
        dead = bytearray(n + 1)
        at, k = 0, None
        while at < n:
            if not low <= at < low + WINDOW:
                low = at // WINDOW * WINDOW
                found = self._found(text, low)
            options = found[at - low]
            k = len(options) - 1 if k is None else k
            while k >= 0:
                rank, size = options[k]
                if not dead[at + size] and (not out or self._final(out[-1], rank)):
                    break
                k -= 1
            if k >= 0:
                out.append(rank)
                tried.append(k)
                at, k = at + size, None
            else:
                if not out:
                    raise ValueError("bytes outside the vocabulary")
                dead[at] = 1
                at -= len(self.token[out.pop()])
                k = tried.pop() - 1
        return out

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pieces(text) for i in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class Memo(dict):
    """Values by text, as remembered in one task: a full generation is kept until the next one is full."""

    def __init__(self, most: int, made: Callable[[str], object]):
        super().__init__()
        self.most, self.made, self.older = most, made, {}

    def __missing__(self, text: str):
        value = self.older.get(text)
        if value is None:
            value = self.made(text)
        if len(text) <= CACHED_LENGTH:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[text] = value
        return value


def chunk_memo(codec: BytePairs) -> Memo:
    """Per chunk the decimal ids, each with a comma after it, and the bytes they decode to."""
    pieces = Memo(CACHED_PIECES, lambda piece: codec.encode_piece(piece.encode()))

    def made(chunk: str) -> tuple[str, bytes]:
        ids = [i for piece in codec.pieces(chunk) for i in pieces[piece]]
        return "".join([f"{i}," for i in ids]), codec.decode(ids)

    return Memo(CACHED_CHUNKS, made)


@lru_cache(1)
def _codec(path: str, pattern: str) -> BytePairs:
    return BytePairs(read_ranks(path), pattern)


@lru_cache(1)
def _memo(path: str, pattern: str) -> Memo:
    """The chunks that this process remembers: tasks that it runs one after another find them warm."""
    return chunk_memo(_codec(path, pattern))


def digests(path: str, pattern: str):
    """For mapInArrow over (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _memo(path, pattern).__getitem__
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column(1):
                parts = list(map(chunk, _chunks(text.as_py() or "")))
                joined = "".join([p[0] for p in parts])
                counts.append(joined.count(","))
                ids.append(hashlib.sha256(joined[:-1].encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([p[1] for p in parts])).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        released()

    return run


def encoded(path: str, pattern: str):
    """For mapInArrow over (doc_id, text): (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([doc_id.as_py()], pa.int64()), pa.array([codec.encode(text.as_py() or "")], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return run


def token_ids(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded(path, pattern), "doc_id long, ids array<int>")


def byte_bpe(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(digests(path, pattern), SCHEMA)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
