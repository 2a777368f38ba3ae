"""Toxicity: cumulative-link ordinal regression over sparse features, words and word stems.

One weight vector serves all severity grades; ordered thresholds cut its score: P(grade <= k) = sigmoid(t_k - w.x). The
model is fitted on a bounded sample of labelled rows (``max_rows`` a class); everything else covers all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellquant.llm.common import materialize, with_fields

STEMS = (4, 5)
_WORDS = re.compile(r"[^\W\d_]+").findall


@dataclass(frozen=True)
class OrdinalModel:
    words: tuple[str, ...]
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than the grades

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0 .. grades - 2, a row for each score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -40, 40)))


def tokens(text: str | None) -> Iterator[str]:
    """Lower-cased words, and the stems of longer ones: their first 4 and 5 letters with a star."""
    for w in _WORDS(text.lower()) if text else ():
        yield w
        for n in STEMS:
            if len(w) > n:
                yield w[:n] + "*"


def features(text: str | None, vocabulary: Container[str]) -> dict[str, float]:
    """log(1 + count) of each token of the vocabulary that the whole text holds."""
    if not text or not vocabulary:
        return {}
    words = _WORDS(text.lower())
    found = [w for w in words if w in vocabulary]
    for n in STEMS:
        found += [s for w in words if len(w) > n and (s := w[:n] + "*") in vocabulary]
    return {w: math.log1p(n) for w, n in Counter(found).items()}


def fit_ordinal(x: np.ndarray, grade: np.ndarray, l2: float = 1e-3, rounds: int = 400, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the balanced negative log-likelihood. Thresholds are a first one and
    positive steps, so they stay ordered, whatever grades are empty."""
    k = int(grade.max(initial=0)) + 1
    if k == 1:  # nothing to separate: every score is far below the only threshold
        return np.zeros(x.shape[1]), np.array([20.0])
    weight = 1.0 / np.bincount(grade > 0, minlength=2).clip(1)[(grade > 0).astype(int)]
    weight /= weight.sum()
    p = np.concatenate([np.zeros(x.shape[1]), [0.5], np.zeros(k - 2)])
    m, v = np.zeros_like(p), np.zeros_like(p)
    d = x.shape[1]
    for i in range(1, rounds + 1):
        steps = np.exp(p[d + 1 :])
        cuts = np.concatenate([[-np.inf], p[d] + np.concatenate([[0], np.cumsum(steps)]), [np.inf]])
        score = x @ p[:d]
        hi, lo = (1 / (1 + np.exp(-np.clip(cuts[grade + j] - score, -40, 40))) for j in (1, 0))
        mass = np.maximum(hi - lo, 1e-12)
        g_hi, g_lo = hi * (1 - hi) / mass, lo * (1 - lo) / mass  # d log(mass) / d cut
        g_hi, g_lo = np.where(grade == k - 1, 0, g_hi) * weight, np.where(grade == 0, 0, g_lo) * weight
        by_cut = np.bincount(grade, g_hi, k)[: k - 1] - np.bincount(grade, g_lo, k)[1:]
        grad = np.concatenate([x.T @ (g_hi - g_lo) + l2 * p[:d], [-by_cut.sum()], -np.cumsum(by_cut[::-1])[::-1][1:] * steps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        p -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return p[:d], p[d] + np.concatenate([[0], np.cumsum(np.exp(p[d + 1 :]))])


def _sample(documents: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """Up to ``max_rows`` labelled documents of each class, by hash order of doc_id, among those that ``documents`` holds. Of
    rows that share a doc_id the least text counts."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.join(documents.select("doc_id"), "doc_id", "left_semi")
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = known.where("toxic = 1").orderBy(*order).limit(max_rows).unionByName(known.where("toxic = 0").orderBy(*order).limit(max_rows))
    texts = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return materialize(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("toxic", "text"), "toxicity-sample")


def _vocabulary(sample: DataFrame, least_docs: int, least_chi2: float, least_log_odds: float) -> list[str]:
    """All words that tell the classes apart: chi-square and smoothed log odds ratio of document frequencies. The sample's
    bound is theirs too."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words = list(set(tokens(text.as_py())))
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([toxic] * len(words), pa.int32())], ["word", "toxic"])

    per_class = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = per_class.get(1, 0), per_class.get(0, 0)
    if not n1 or not n0:
        return []
    counts = sample.mapInArrow(distinct, "word string, toxic int").groupBy("word").agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
    c, d = F.lit(float(n1)) - F.col("a"), F.lit(float(n0)) - F.col("b")
    chi2 = (n1 + n0) * F.pow(F.col("a") * d - F.col("b") * c, 2) / (F.lit(float(n1) * n0) * (F.col("a") + F.col("b")) * (c + d + 1e-9))
    odds = F.log((F.col("a") + 0.5) * (d + 0.5) / ((F.col("b") + 0.5) * (c + 0.5)))
    told = counts.where(F.col("a") + F.col("b") >= least_docs).withColumns({"chi2": chi2, "odds": odds})
    told = told.where((F.col("chi2") >= least_chi2) & (F.abs("odds") >= least_log_odds)).orderBy(F.desc("chi2"), "word")
    return [r["word"] for r in told.select("word").collect()]


def train_toxicity(
    documents: DataFrame, labels: DataFrame, *, max_rows: int = 4096, least_docs: int = 3, least_chi2: float = 30.0, least_log_odds: float = 1.5
) -> OrdinalModel:
    """Fit on at most ``max_rows`` labelled documents a class (``labels``: doc_id, toxic 0/1; a document with several
    labels takes the largest; null labels are passed over).

    Grades: 0 for clean; toxic documents are 1 or 2, cut at the median of how much toxic wording they hold (occurrences
    of tokens that toxic documents hold more of). With no labels of a class, no documents, or labels of none of them,
    nothing is held toxic.
    """
    sample = _sample(documents, labels, max_rows)
    words = _vocabulary(sample, least_docs, least_chi2, least_log_odds)
    index = {w: i for i, w in enumerate(words)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            xs = [features(t, index) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([[index[w] for w in x] for x in xs], pa.list_(pa.int32())), pa.array([list(x.values()) for x in xs], pa.list_(pa.float64()))],
                ["toxic", "at", "x"],
            )

    rows = sample.mapInArrow(vectors, "toxic int, at array<int>, x array<double>").collect()  # at most 2 * max_rows
    x = np.zeros((len(rows), len(words)), np.float32)
    for i, r in enumerate(rows):
        x[i, r["at"]] = r["x"]
    toxic = np.array([r["toxic"] for r in rows], int)
    if not words or not toxic.any():
        return OrdinalModel((), np.zeros(0), np.array([20.0, 21.0]))
    lean = x[toxic == 1].mean(0) > x[toxic == 0].mean(0) if (toxic == 0).any() else np.ones(len(words), bool)
    held = np.expm1(x[:, lean]).sum(1)
    grade = toxic * (1 + (held > np.median(held[toxic == 1])))
    weights, cuts = fit_ordinal(x, grade)
    return OrdinalModel(tuple(words), weights, cuts)


def score_toxicity(documents: DataFrame, model: OrdinalModel, *, threshold: float = 0.5) -> DataFrame:
    """Every row with severity (expected grade), grade (most probable), p_toxic and toxic (p_toxic >= ``threshold``).

    A null or empty text has no features. Repeated rows each get a row, an empty table gives an empty result. Columns of
    ``documents`` stay, except those with one of these names.
    """
    made = ("severity", "grade", "p_toxic", "toxic")
    kept = [c for c in documents.columns if c not in made]
    rows = documents.select(*kept)
    shared = documents.sparkSession.sparkContext.broadcast((model, dict(zip(model.words, model.weights.tolist(), strict=True))))  # words of the bounded sample
    place = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weights = shared.value
        for b in batches:
            score = np.fromiter((sum(weights[w] * x for w, x in features(t.as_py(), weights).items()) for t in b.column(place)), float, b.num_rows)
            above = model.above(score)
            each = -np.diff(np.column_stack([np.ones(len(score)), above, np.zeros(len(score))]))
            new = [pa.array(above.sum(1)), pa.array(each.argmax(1).astype(np.int32)), pa.array(above[:, 0]), pa.array(above[:, 0] >= threshold)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*kept, *made])

    return rows.mapInArrow(run, with_fields(rows, "severity double, grade int, p_toxic double, toxic boolean"))
