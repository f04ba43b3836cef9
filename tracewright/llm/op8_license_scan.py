"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license templates.

A block is a run of words of a document, whatever line breaks it holds: ``SPAN`` times as many words as the template
has. A template is met when a block holds at least ``CONTAINMENT`` of the template's distinct words. Template words are
ordered by their frequency over the whole corpus, rare first; a block that meets a template must hold one of the
template's first ``size - needed + 1`` words (prefix filter) and ``needed`` occurrences of its words (length filter).
What remains is counted exactly, at every place where a block can start.

Frequencies are sums per task of the template words alone, so what is gathered is as large as the template list. The
template list and its index are broadcast: they are a parameter, not data.

Nulls: a null text is empty (no words, no labels, score 0). A null id passes through; repeated rows get equal answers;
an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text_arrays as ta
from .common import table

CONTAINMENT = 0.9
#: Words of a block for each word of the template: room for what authors put between a notice's words.
SPAN = 3
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
#: Fixed by the contract: phrases whose words stand consecutively, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Short notices as authors write them.
TEMPLATES = {
    "released under the MIT license": "mit",
    "licensed under the Apache License, Version 2.0": "apache-2",
    "licensed under CC BY-NC 4.0": "cc-by-nc",
    "licensed under CC BY-SA 4.0": "cc-by-sa",
    "Creative Commons Attribution 4.0 International": "cc-by",
    "GNU General Public License, version 3": "gpl-3",
    "GNU General Public License, version 2": "gpl-2",
    "GNU Lesser General Public License": "lgpl",
    "GNU Affero General Public License": "agpl",
    "redistribution and use in source and binary forms, with or without modification, are permitted": "bsd",
    "permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit",
    "subject to the terms of the Mozilla Public License, v. 2.0": "mpl-2",
}

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall


def words_of(text: str) -> list[bytes]:
    return _words(bytes(ta.LOWER[np.frombuffer(text.encode(), np.uint8)]))


def _hash_words(words: list[bytes]) -> np.ndarray:
    """The hashes that scanning finds for these words."""
    joined = np.frombuffer(b" ".join(words), np.uint8)
    t = ta.Texts(0, 1, joined, np.array([0, len(joined)]))
    return t.hashes(*t.spans(_WORD[joined])) if words else np.zeros(0, ta.U64)


def _word_hashes(t: ta.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and their documents."""
    starts, ends = t.spans(_WORD[t.data])
    return t.hashes(starts, ends), t.doc_of(starts)


def counted(vocabulary: np.ndarray):
    """For mapInArrow over (text): how often each vocabulary word occurs, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for t in ta.slices(batch.column(0), lower=True):
                words = _word_hashes(t)[0]
                at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                seen += np.bincount(at[vocabulary[at] == words], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocabulary))), pa.array(seen)], names=["word", "n"])

    return run


def frequencies(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences in the corpus of each of the (few, given) words."""
    out = np.zeros(len(vocabulary), np.int64)
    for r in docs.select("text").mapInArrow(counted(vocabulary), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        out[r.word] = r.n
    return out


class TemplateIndex:
    """Templates as sets in global order, with the words of their prefixes indexed."""

    def __init__(self, templates: dict[str, str], containment: float, phrases: dict[str, str]):
        self.sets = [np.unique(_hash_words(words_of(t))) for t in templates]
        self.labels = list(templates.values())
        self.spans = [SPAN * len(words_of(t)) for t in templates]
        self.containment = containment
        self.vocabulary = np.unique(np.concatenate(self.sets))
        self.phrases = [(_hash_words(words_of(p)), label) for p, label in phrases.items()]

    def order(self, counts: np.ndarray) -> TemplateIndex:
        rank = np.empty(len(counts), np.int64)
        rank[np.lexsort((self.vocabulary, counts))] = np.arange(len(counts))
        self.by_rank = self.vocabulary[np.argsort(rank)]
        self.rank = rank
        self.ranked = [np.sort(rank[np.searchsorted(self.vocabulary, s)]) for s in self.sets]
        self.needed = [int(np.ceil(self.containment * len(s) - 1e-9)) for s in self.sets]
        return self

    def met(self, words: np.ndarray, docs: np.ndarray) -> list[tuple[int, int, float]]:
        """(document, template, largest containment) of every document with a block that meets the template."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == words)
        ranks = self.rank[at[known]]
        out = []
        for k, ranked in enumerate(self.ranked):
            size, needed = len(ranked), self.needed[k]
            of_template = np.zeros(len(self.vocabulary), bool)
            of_template[ranked] = True
            inside = of_template[ranks]
            places, held = known[inside], ranks[inside]
            if len(places) < needed:
                continue
            of = docs[places]
            # a block that starts at places[i] holds the occurrences i to ends[i]
            ends = np.minimum(np.searchsorted(places, places + self.spans[k]), np.searchsorted(of, of, side="right"))
            rare = np.concatenate(([0], np.cumsum(held <= ranked[size - needed])))
            begins = np.arange(len(places))
            best: dict[int, int] = {}
            for i in np.flatnonzero((ends - begins >= needed) & (rare[ends] > rare[begins])).tolist():
                d = int(of[i])
                if best.get(d, 0) < size:
                    best[d] = max(best.get(d, 0), len(set(held[i : ends[i]].tolist())))
            out += [(d, k, shared / size) for d, shared in best.items() if shared >= needed]
        return out


def scanned(index: TemplateIndex):
    """For mapInArrow over (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in ta.slices(batch.column(1), lower=True):
                words, docs = _word_hashes(t)
                n_words = ta.per_doc_sum(docs, t.count)
                first_in_doc = np.concatenate(([0], np.cumsum(n_words)))
                base: list[set[str]] = [set() for _ in range(t.count)]
                places = []
                for phrase, label in index.phrases:
                    n = len(words) - len(phrase) + 1
                    hit = docs[: max(n, 0)] == docs[len(phrase) - 1 :] if n > 0 else np.zeros(0, bool)
                    for j, w in enumerate(phrase):
                        hit &= words[j : j + max(n, 0)] == w
                    at = np.flatnonzero(hit)
                    places.append(at)
                    for d in np.unique(docs[at]).tolist():
                        base[d].add(label)
                places = np.concatenate(places)
                n_base = ta.per_doc_sum(docs[places], t.count)
                first, last = np.full(t.count, 1 << 62), np.full(t.count, -1)
                inner = places - first_in_doc[docs[places]]
                np.minimum.at(first, docs[places], inner)
                np.maximum.at(last, docs[places], inner)
                labels = [set(x) for x in base]
                score = np.array([1.0 if x else 0.0 for x in base])
                for d, k, share in index.met(words, docs):
                    labels[d].add(index.labels[k])
                    score[d] = max(score[d], share)
                none = n_base == 0
                joined = lambda sets: pa.array([",".join(sorted(x)) for x in sets], pa.string())
                cols = [batch.column(0).slice(t.first, t.count), pa.array(n_words), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none), joined(base), joined(labels), pa.array(score)]
                yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return run


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, phrases: dict[str, str] = PHRASES) -> DataFrame:
    index = TemplateIndex(templates, containment, phrases)
    index.order(frequencies(docs, index.vocabulary))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scanned(index), SCHEMA)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
