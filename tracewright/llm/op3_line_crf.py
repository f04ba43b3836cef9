"""Quality rules by line sequence labelling: a linear-chain conditional random field with Viterbi decoding.

A document's lines with at least one word are a sequence; each is labelled content or boilerplate from features of
the line and the labels of its neighbours. The share of words in content lines decides retention, after two base rules
(too few words; too many words in repeated 8-word windows).

The field is fitted on a bounded sample of labelled documents (``FIT_DOCS``, taken by hash order of the id). Labels are
per document, so line labels come in two steps: a logistic model of the document's label on its lines gives a first
guess, lines of a bad document that look like content are relabelled so, then the field's conditional likelihood is
maximised with forward-backward sums.

Nulls: a null text counts as empty: zero counts, base_failed true, kept false. Empty tables give empty results; repeated
rows are judged alike; a null id passes through. Without labelled rows the fixed starting weights below decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text_arrays as ta
from .common import table

FIT_DOCS = 3000
#: Lines of a document at most for it to be in the sample.
FIT_LINES = 2000
MIN_CONTENT = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_words long, kept boolean"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ASCII_LETTER = _UPPER.copy()
_ASCII_LETTER[97:123] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[[ord("!"), ord("?")]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord("!"), ord("?"), ord(":"), ord(";")]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_CONTINUATION = (np.arange(256) & 0xC0) == 0x80

FEATURES = ("bias", "symbols", "upper", "shouts", "digits", "repeats", "duplicate", "short", "long_words", "ends")


@dataclass
class Field:
    """Weights of label 1 (content) against 0: per feature, and for the pairs (previous, next) of labels."""

    emit: np.ndarray
    step: np.ndarray

    @staticmethod
    def start() -> Field:
        return Field(np.array([3.0, -6.0, -4.0, -4.0, -2.0, -4.0, -1.0, -0.5, -1.0, 0.5]), np.array([[0.5, 0.0], [0.0, 0.5]]))


def line_features(t: ta.Texts) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts per document; then per line with a word its features, its document and its word count."""
    inside = ~ta.SPACE[t.data]
    starts, ends = t.spans(inside)
    docs = t.doc_of(starts)
    words = t.hashes(starts, ends)
    counts = {
        "n_words": ta.per_doc_sum(docs, t.count),
        "word_chars": t.per_doc(inside & ~_CONTINUATION[t.data]),
        "n_symbols": t.per_doc(_SYMBOL[t.data]),
    }

    grams, at = ta.gram_hashes(words, docs, WINDOW)
    _, back, times = np.unique(ta.mixed(grams + docs[at].astype(ta.U64) * ta._STEP), return_inverse=True, return_counts=True)
    edge = np.zeros(len(words) + 1, np.int64)
    found = at[times[back] > 1]
    np.add.at(edge, found, 1)
    np.add.at(edge, found + WINDOW, -1)
    counts["n_repeat_words"] = ta.per_doc_sum(docs[np.cumsum(edge[:-1]) > 0], t.count)

    breaks = np.flatnonzero(t.data == 10)
    line_starts = np.unique(np.concatenate((t.offsets[:-1], breaks + 1)))
    line_starts = line_starts[line_starts < len(t.data)]
    line_ends = np.append(line_starts[1:], len(t.data))[: len(line_starts)]
    line_ends = line_ends - (t.data[line_ends - 1] == 10)
    line_of = np.searchsorted(line_starts, starts, side="right") - 1
    n_words = np.bincount(line_of, minlength=len(line_starts))
    has = n_words > 0
    order = np.cumsum(has) - 1
    line_of, n_words, ls, le = order[line_of], n_words[has], line_starts[has], line_ends[has]
    line_doc = t.doc_of(ls)
    lines = t.hashes(ls, le)
    key = ta.mixed(lines + line_doc.astype(ta.U64) * ta._STEP)
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    counts["n_dup_lines"] = ta.per_doc_sum(line_doc[again], t.count)

    def share(table: np.ndarray, by: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[t.data], dtype=np.int64)))
        return (sums[le] - sums[ls]) / by

    size = np.maximum(le - ls, 1)
    pair = ta.mixed(words + line_of.astype(ta.U64) * ta._STEP)
    _, firsts = np.unique(pair, return_index=True)
    distinct = np.bincount(line_of[firsts], minlength=len(ls))
    x = np.stack(
        (
            np.ones(len(ls)),
            np.minimum(share(_SYMBOL, n_words), 1.0),
            share(_UPPER, np.maximum(share(_ASCII_LETTER, 1), 1)),
            np.minimum(share(_SHOUT, n_words), 1.0),
            share(_DIGIT, size),
            1 - distinct / np.maximum(n_words, 1),
            again.astype(float),
            (n_words < 4).astype(float),
            np.minimum(size / np.maximum(n_words, 1) / 20, 2.0),
            _STOP[t.data[le - 1]].astype(float) if len(le) else np.zeros(0),
        ),
        axis=1,
    )
    return counts, x, line_doc, n_words


def _padded(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents that have lines, longest first; where each one's lines start, and how many there are."""
    firsts = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]]) if len(docs) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(firsts, len(docs)))
    order = np.argsort(-sizes, kind="stable")
    return firsts[order], sizes[order], order


def viterbi(field: Field, x: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The likeliest label of each line, all documents in step: step k handles line k of those that have one."""
    labels = np.zeros(len(x), np.int8)
    if not len(x):
        return labels
    score = x @ field.emit
    firsts, sizes, _ = _padded(docs)
    back = np.zeros((len(x), 2), np.int8)
    best = np.stack((np.zeros(len(firsts)), score[firsts]), axis=1)
    for k in range(1, sizes[0]):
        m = int(np.searchsorted(-sizes, -k, side="left"))  # those with more than k lines
        at = firsts[:m] + k
        to = best[:m, :, None] + field.step[None]
        back[at] = to.argmax(axis=1)
        best[:m] = to.max(axis=1)
        best[:m, 1] += score[at]
    now = best.argmax(axis=1)
    labels[firsts + sizes - 1] = now
    for k in range(sizes[0] - 1, 0, -1):
        m = int(np.searchsorted(-sizes, -k, side="left"))
        at = firsts[:m] + k
        now[:m] = back[at, now[:m]]
        labels[at - 1] = now[:m]
    return labels


def _gradient(field: Field, x: np.ndarray, y: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Observed minus expected feature sums, by forward-backward in log space."""
    score = x @ field.emit
    node = np.stack((np.zeros(len(x)), score), axis=1)
    firsts, sizes, _ = _padded(docs)
    alpha, beta = node.copy(), np.zeros((len(x), 2))
    spans = [firsts[: int(np.searchsorted(-sizes, -k, side="left"))] + k for k in range(1, sizes[0])]
    for at in spans:
        alpha[at] = node[at] + np.logaddexp.reduce(alpha[at - 1][:, :, None] + field.step[None], axis=1)
    for at in spans[::-1]:
        beta[at - 1] = np.logaddexp.reduce(field.step[None] + (node[at] + beta[at])[:, None, :], axis=2)
    log_z = np.repeat(np.logaddexp.reduce(alpha[firsts + sizes - 1], axis=1)[np.argsort(firsts)], sizes[np.argsort(firsts)])
    p = np.exp(alpha + beta - log_z[:, None])
    emit = x.T @ (y - p[:, 1])
    step = np.zeros((2, 2))
    if spans:
        at = np.concatenate(spans)
        pair = np.exp(alpha[at - 1][:, :, None] + field.step[None] + (node[at] + beta[at])[:, None, :] - log_z[at][:, None, None])
        np.add.at(step, (y[at - 1].astype(int), y[at].astype(int)), 1)
        step -= pair.sum(axis=0)
    return emit, step


def _climb(field: Field, gradient, n: int, steps: int = 150, rate: float = 0.1, decay: float = 1e-3) -> Field:
    """Adam on a concave objective with a quadratic penalty."""
    w = np.concatenate((field.emit, field.step.ravel()))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        emit, step = gradient(Field(w[:-4], w[-4:].reshape(2, 2)))
        g = np.concatenate((emit, step.ravel())) / n - decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return Field(w[:-4], w[-4:].reshape(2, 2))


def fit(texts: list[str], good: list[int]) -> Field:
    """A field from documents labelled as a whole."""
    parts = [(line_features(t), t) for t in ta.slices(pa.array(texts, pa.string()))]
    docs = [found[2] + t.first for found, t in parts]
    x = [found[1] for found, _ in parts]
    return fit_lines(np.concatenate(x), np.concatenate(docs), np.asarray(good)) if x else Field.start()


def fit_lines(x: np.ndarray, docs: np.ndarray, good: np.ndarray) -> Field:
    """A field from the features of lines, the document of each (in order), and the documents' labels."""
    if not len(x) or len(set(good.tolist())) < 2:
        return Field.start()
    y = good[docs].astype(float)
    bad = y == 0
    weight = np.where(bad, 0.5 / max(bad.sum(), 1), 0.5 / max((~bad).sum(), 1)) * len(x)
    flat = _climb(Field.start(), lambda f: (x.T @ (weight * (y - 1 / (1 + np.exp(-x @ f.emit)))), np.zeros((2, 2))), len(x))
    y = np.where(bad & (x @ flat.emit > 0), 1.0, y)
    return _climb(Field(flat.emit, Field.start().step), lambda f: _gradient(f, x, y, docs), len(x))


def judged(field: Field):
    """For mapInArrow over (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in ta.slices(batch.column(1)):
                counts, x, docs, n_words = line_features(t)
                content = ta.per_doc_sum(docs, t.count, n_words * viterbi(field, x, docs))
                words = counts["n_words"]
                failed = (words < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * words)
                kept = ~failed & (content >= MIN_CONTENT * words)
                cols = [counts[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.first, t.count), *(pa.array(c) for c in (*cols, failed, content, kept))], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return run


def _sampled_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, h, quality, text): the line features of each document, as bytes."""
    for batch in batches:
        for t in ta.slices(batch.column(3)):
            _, x, docs, _ = line_features(t)
            edges = np.searchsorted(docs, np.arange(t.count + 1))
            blobs = [x[a:b].astype("<f8").tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.slice(t.first, t.count).columns[:3], pa.array(np.diff(edges)), pa.array(blobs, pa.binary())], names=["doc_id", "h", "quality", "lines", "x"])


def fitted(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCS, most_lines: int = FIT_LINES) -> Field:
    """Fitted on at most ``most`` labelled documents of at most ``most_lines`` lines each, taken by hash order of the id.

    What reaches the driver are the lines' features. Of rows with one id, that with the least hash of its text counts.
    """
    chosen = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", F.xxhash64("text").alias("h"), "quality", "text")
    found = rows.mapInArrow(_sampled_lines, "doc_id long, h long, quality int, lines long, x binary").where(F.col("lines") <= most_lines)
    one = found.groupBy("doc_id").agg(F.min_by("x", "h").alias("x"), F.min("quality").alias("quality")).orderBy("doc_id").toPandas()
    if not len(one):
        return Field.start()
    xs = [np.frombuffer(x, "<f8").reshape(-1, len(Field.start().emit)) for x in one["x"]]
    return fit_lines(np.concatenate(xs), np.repeat(np.arange(len(xs)), [len(x) for x in xs]), one["quality"].to_numpy())


def line_rules(docs: DataFrame, field: Field) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(judged(field), SCHEMA)


def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_rules(docs, fitted(docs, table(spark, sf_dir, "labels")))
