"""Quality classifier by positive-unlabelled learning with the non-negative unbiased risk (Kiryo et al. 2017).

Trusted positives are labelled documents of quality 1 outside the held-out fifth; the unlabelled side is documents
without a training label. The class prior of the unlabelled side is estimated from the two samples: with a first
classifier, the least ratio of the unlabelled share to the positive share above a score. The risk
``prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)])`` is then minimised for a linear model over binned
text statistics; where the second term turns negative its gradient is reversed. Scores are sigmoids of the logit.

Both samples are bounded (``POSITIVES``, ``UNLABELLED``) and taken by hash order of the id, so they don't depend on
partitioning; scoring covers every document. Inputs of a score are statistics of the text alone.

Nulls: a null text is scored as empty; a null id passes through unscored by labels (held_out null id: false). Repeated
rows get equal scores; rows of one id count once in a sample. Very long texts are scored whole, one at a time. Without positives the score is 0.5 everywhere. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text_arrays as ta
from .common import table

POSITIVES = 3000
UNLABELLED = 6000
#: Statistics are cut at these quantiles; the tails are where odd texts show.
CUTS = (0.01, 0.02, 0.04, 0.08, 0.2, 0.5, 0.8, 0.88, 0.92, 0.94, 0.96, 0.98, 0.99)
BINS = len(CUTS) + 1
THRESHOLD = 0.3
FOLDS = 5
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_CLASSES = {"symbols": "#*$%&|<>_~^=+", "shouts": "!?", "digits": "0123456789", "quotes": "'\"()[]{}", "stops": ".:;"}


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_TABLES = {k: _flags(v) for k, v in _CLASSES.items()}
_UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def statistics(t: ta.Texts) -> np.ndarray:
    """One row a document."""
    inside = ~ta.SPACE[t.data]
    starts, ends = t.spans(inside)
    docs = t.doc_of(starts)
    words = t.hashes(starts, ends)
    n = np.maximum(ta.per_doc_sum(docs, t.count), 1)
    sizes = np.maximum(np.diff(t.offsets), 1)
    key = ta.mixed(words + docs.astype(ta.U64) * ta._STEP)
    _, first = np.unique(key, return_index=True)
    distinct = ta.per_doc_sum(docs[first], t.count)
    same = np.zeros(len(words), bool)
    same[1:] = (words[1:] == words[:-1]) & (docs[1:] == docs[:-1])
    pairs, at = ta.gram_hashes(words, docs, 2)
    _, first = np.unique(ta.mixed(pairs + docs[at].astype(ta.U64) * ta._STEP), return_index=True)
    pair_docs = docs[at]
    n_pairs = np.maximum(ta.per_doc_sum(pair_docs, t.count), 1)
    columns = [t.per_doc(table[t.data]) / n for table in _TABLES.values()]
    columns += [
        t.per_doc(_UPPER[t.data]) / np.maximum(t.per_doc(_LETTER[t.data]), 1),
        t.per_doc(inside) / n,
        t.per_doc(t.data >= 128) / sizes,
        distinct / n,
        ta.per_doc_sum(docs[same], t.count) / n,
        ta.per_doc_sum(pair_docs[first], t.count) / n_pairs,
        t.per_doc(t.data == 10) / n,
        np.log1p(n),
    ]
    return np.stack(columns, axis=1)


@dataclass
class Scorer:
    edges: np.ndarray
    weights: np.ndarray
    prior: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        """Indicator of the bin of each statistic, and a constant."""
        n, k = x.shape
        out = np.zeros((n, k * BINS + 1), np.float32)
        out[:, -1] = 1
        for j in range(k):
            out[np.arange(n), j * BINS + np.searchsorted(self.edges[j], x[:, j], side="right")] = 1
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(x) @ self.weights, -30, 30)))


def risk(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """The two terms of the unbiased risk under the sigmoid loss: of the positives, and of the negatives among ``u``."""
    sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
    return float(prior * np.mean(1 - sp)), float(np.mean(su) - prior * np.mean(sp))


def risk_gradient(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Of both terms; where the second is negative, its own with the sign turned (the non-negative correction)."""
    # the sigmoid loss is bounded, so that neither side of the difference runs away
    sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
    of_p = prior * (p.T @ (sp * (1 - sp))) / len(p)
    minus = (u.T @ (su * (1 - su))) / len(u) - of_p
    return minus - of_p if su.mean() - prior * sp.mean() >= 0 else -minus


def _adam(gradient, size: int, steps: int = 400, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for k in range(1, steps + 1):
        g = gradient(w) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimated_prior(p_scores: np.ndarray, u_scores: np.ndarray) -> float:
    """The ratio of upper tails at the cut with the least upper confidence bound (best bin estimation, Garg et al. 2021)."""
    slack = sum(np.sqrt(np.log(40) / 2 / len(x)) for x in (p_scores, u_scores))
    found = []
    for c in np.quantile(p_scores, np.linspace(0.0, 0.9, 91)):
        p, u = np.mean(p_scores >= c), np.mean(u_scores >= c)
        found.append(((u + slack) / p, u / p))
    return float(np.clip(min(found)[1], 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Scorer:
    """From the statistics of trusted positives and of unlabelled text."""
    both = np.concatenate((positive, unlabelled))
    edges = np.stack([np.quantile(both[:, j], CUTS) for j in range(both.shape[1])]) if len(both) else np.zeros((13, BINS - 1))
    scorer = Scorer(edges, np.zeros(edges.shape[0] * BINS + 1), 0.5)
    if len(positive) < 10 or len(unlabelled) < 10:
        return scorer
    p, u = scorer.inputs(positive), scorer.inputs(unlabelled)
    half_p, half_u = np.arange(len(p)) % 2 == 0, np.arange(len(u)) % 2 == 0
    first = _adam(lambda w: (p[half_p].T @ (_sigmoid(p[half_p] @ w) - 1)) / half_p.sum() + (u[half_u].T @ _sigmoid(u[half_u] @ w)) / half_u.sum(), p.shape[1], 200)
    prior = estimated_prior(p[~half_p] @ first, u[~half_u] @ first)

    return Scorer(edges, _adam(lambda w: risk_gradient(w, p, u, prior), p.shape[1]), prior)


def fold(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def text_statistics(texts: list[str | None]) -> np.ndarray:
    parts = [statistics(t) for t in ta.slices(pa.array(texts, pa.string()))]
    return np.concatenate(parts) if parts else np.zeros((0, 13))


def _chosen(docs: DataFrame, ids: DataFrame, most: int) -> np.ndarray:
    """Statistics of at most ``most`` documents, the first by hash of the id; of rows with one id, that with the least hash."""
    taken = ids.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("doc_id", F.xxhash64("text").alias("h"), "text")
    found = rows.mapInArrow(_as_statistics, "doc_id long, h long, x array<double>").groupBy("doc_id").agg(F.min_by("x", "h").alias("x"))
    one = found.orderBy("doc_id").toPandas()
    return np.stack(one["x"].to_list()) if len(one) else np.zeros((0, 13))


def _as_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (doc_id, h, text)."""
    for batch in batches:
        for t in ta.slices(batch.column(2)):
            yield pa.RecordBatch.from_arrays([*batch.slice(t.first, t.count).columns[:2], pa.array(list(statistics(t)), pa.list_(pa.float64()))], names=["doc_id", "h", "x"])


def scored(scorer: Scorer):
    """For mapInArrow over (doc_id, held_out, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in ta.slices(batch.column(2)):
                s = scorer.scores(statistics(t))
                cols = [batch.column(0).slice(t.first, t.count), batch.column(1).slice(t.first, t.count), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted"])

    return run


def fitted(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Scorer:
    """Fitted on samples of at most so many trusted positives and unlabelled rows."""
    trained = labels.where((fold() != 0) & F.col("quality").isNotNull())
    p = _chosen(docs, trained.where("quality = 1"), positives)
    u = _chosen(docs, docs.select("doc_id").join(trained.select("doc_id"), "doc_id", "left_anti"), unlabelled)
    return fit(p, u)


def quality_scores(docs: DataFrame, scorer: Scorer) -> DataFrame:
    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), held_out, "text").mapInArrow(scored(scorer), SCHEMA)


def accepted(scorer: Scorer):
    """A function of a text Column: whether the text is predicted to be of quality."""

    @F.arrow_udf("boolean")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([scorer.scores(statistics(t)) >= THRESHOLD for t in ta.slices(texts)] or [np.zeros(0, bool)]))

    return run


def quality_documents(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """The rows, with all their columns, whose text is predicted to be of quality; only texts go to Python."""
    return docs.where(accepted(scorer)("text"))


def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fitted(docs, table(spark, sf_dir, "labels")))
