"""A quality classifier from trusted positives and unlabelled text.

A logistic model over counts of a text's own characters and words is fitted by
minimising the non-negative unbiased risk (Kiryo et al., NeurIPS 2017):

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with l(z) = 1 / (1 + exp(z)), P the trusted positives and U unlabelled documents;
the loss is bounded, so that a few far documents do not outweigh the small
difference of the two samples.  No negative label is used.  The class prior is estimated from the same two
samples: a first model tells P from U, and on documents it was not fitted on the
share of U above a cut over the share of P above it is smallest where U holds
positives only (Blanchard, Lee and Scott, JMLR 2010).

Fitting uses at most about ``SAMPLE`` documents of each kind, picked by a hash
of their id; every document is scored, by its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import col

#: Documents of each kind that the model is fitted on, at most (give or take what the hash picks).
SAMPLE = 20_000
CUT = 0.7
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def features(text: bytes | None) -> list[float]:
    """Shares of marks, letters and repetition in a text, 0 to 1 each, square roots too; of an empty text, zeros."""
    text = text or b""
    words = text.split()
    n, size = len(words), max(len(text), 1)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [x for x in text.split(b"\n") if x.strip()]
    shares = [*(counts[list(_MARKS)] / size), counts[48:58].sum() / size, counts[65:91].sum() / size,
              counts[97:123].sum() / size, counts[128:].sum() / size, counts[10] / size,
              sum(map(eq, words, words[1:])) / max(n - 1, 1), 1 - len(set(words)) / max(n, 1),
              1 - len(set(lines)) / max(len(lines), 1), min(1.0, n and sum(map(len, words)) / n / 40),
              min(1.0, np.log1p(n) / 15)]
    return [*shares, *np.sqrt(shares)]


def _table(texts: pa.Array) -> np.ndarray:
    return np.array([features(t.as_py()) for t in texts.cast(pa.binary())], np.float64).reshape(len(texts), -1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(gradient, width: int, steps: int = 600, rate: float = 0.05) -> np.ndarray:
    """Adam on a full-batch gradient from zero."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def nn_risk(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk: of positives, and of negatives before it is held at zero."""
    sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
    return prior * float((1 - sp).mean()), float(su.mean()) - prior * float(sp.mean())


def fit_nn_pu(p: np.ndarray, u: np.ndarray, prior: float, ridge: float = 1e-2) -> np.ndarray:
    """Weights that minimise the non-negative risk; where its negative part falls under zero, steps raise it."""
    def gradient(w):
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        slope_p, negative = (sp * (1 - sp)) @ p / len(p), su.mean() - prior * sp.mean()
        rise = (su * (1 - su)) @ u / len(u) - prior * slope_p
        return ridge * w - rise if negative < 0 else ridge * w + rise - prior * slope_p
    return _descend(gradient, p.shape[1])


def estimate_prior(p: np.ndarray, u: np.ndarray, least: float = 0.3, folds: int = 5, ridge: float = 1e-2) -> float:
    """Share of positives in ``u``: the smallest ratio of tails, over cuts that keep ``least`` of ``p``.

    Every row is scored by a model that was fitted without its fold.
    """
    if min(len(p), len(u)) < 2 * folds:
        return 0.5
    scores = [], []
    for fold in range(folds):
        (fit_p, own_p), (fit_u, own_u) = ((x[np.arange(len(x)) % folds != fold], x[np.arange(len(x)) % folds == fold]) for x in (p, u))

        def gradient(w):
            return (ridge * w + _sigmoid(fit_u @ w) @ fit_u / len(fit_u)
                    - (1 - _sigmoid(fit_p @ w)) @ fit_p / len(fit_p))
        w = _descend(gradient, p.shape[1], 300)
        scores[0].append(own_p @ w)
        scores[1].append(own_u @ w)
    sp, su = (np.sort(np.concatenate(x)) for x in scores)
    cuts = np.quantile(sp, np.linspace(0.0, 1 - least, 60))
    ratio = (1 - np.searchsorted(su, cuts) / len(su)) / (1 - np.searchsorted(sp, cuts) / len(sp))
    return float(np.clip(ratio.min(), 0.05, 0.99))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return _sigmoid(z @ self.weights[:-1] + self.weights[-1])

    def score(self, text: Column) -> Column:
        @F.arrow_udf("double")
        def run(texts: pa.Array) -> pa.Array:
            return pa.array(self.scores(_table(texts)))
        return run(text)


def fit(p: np.ndarray, u: np.ndarray) -> Model:
    """A model from the features of positives and of unlabelled documents; without either nothing speaks against
    a document, and all scores are 1."""
    width = len(features(b""))
    if not len(p) or not len(u):
        return Model(np.zeros(width), np.ones(width), np.append(np.zeros(width), 40.0), 1.0)
    mean, scale = u.mean(axis=0), np.maximum(u.std(axis=0), 1e-3)
    ready = lambda x: np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
    p, u = ready(p), ready(u)
    prior = estimate_prior(p, u)
    return Model(mean, scale, fit_nn_pu(p, u, prior), prior)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _picked(rows: DataFrame, wanted: int, there: int, seed: int) -> DataFrame:
    """About ``wanted`` of ``rows``, by a hash of id and text: one id's texts are picked apart, equal rows are one."""
    share = min(1.0, wanted / max(there, 1))
    hit = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))
    return rows.filter(hit).dropDuplicates(["doc_id", "text_hash"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on rows that are not held out: ``labels`` (doc_id, quality) names the positives, all others are unlabelled.

    A document with several labels is a positive if all are 1; labels without a
    document do not count.  At most about ``sample`` rows of either kind reach
    the driver, as features, however often an id or a row repeats.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x.tobytes() for x in _table(batch.column(1)).astype(np.float32)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["doc_id", "x"])

    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("text_hash", F.xxhash64("text"))
    good = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q"))
            .filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min(F.coalesce("q", F.lit(0))).alias("q")).filter("q = 1").select("doc_id"))
    known = rows.join(good, "doc_id", "left_semi")
    found = []
    # in order of id, so that a rerun adds the same numbers in the same order
    for of, seed in ((known, 101), (rows, 102)):
        picked = _picked(of, sample, of.select("doc_id").count(), seed).select("doc_id", "text")
        taken = sorted((r.doc_id, bytes(r.x)) for r in picked.mapInArrow(run, "doc_id long, x binary").collect())
        found.append(np.frombuffer(b"".join([x for _, x in taken]), np.float32).reshape(len(taken), len(features(b""))).astype(np.float64))
    return fit(*found)


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT,
                       sample: int = SAMPLE, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted[, held]) for every row of ``docs``.

    NULL and blank texts are scored like any other, as texts without words;
    NULL ids are never learned from nor held out; repeated rows have equal
    scores; with ``carry`` those columns come back in a struct ``held``.
    Without positives every score is 1: all documents are kept.  An empty table gives an empty
    result.
    """
    model = train(docs, labels, id_col, text_col, sample)
    key = col(id_col).cast("long")
    held = [F.struct(*[col(c) for c in carry]).alias("held")] if carry else []
    scored = docs.select(key.alias("doc_id"), held_out(key).alias("held_out"),
                         model.score(col(text_col).cast("string")).alias("score"), *held)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"),
                         *(["held"] if carry else []))
