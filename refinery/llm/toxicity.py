"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all learning rows together, their
labels set aside, are the unlabelled text, which the class prior describes. A linear model over the presence of hashed features
minimises the class-prior-corrected risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the sigmoid loss; where the corrected negative part falls below zero, the
step goes the other way, as non-negative learning does. The cut is the point of
least estimated error under the same prior, and scores are placed so that 0.7 is
that cut.

The sample is bounded (``POSITIVES``, ``UNLABELLED``). Sample and class prior
describe one population, the distinct texts: the prior is counted over all
labelled ones, and a sampled text weighs as much as its near copies that were
drawn with it. Features are chosen with near copies left out; scoring reads whole
texts.

Defined cases: null or empty text scores as a text without features; labels of
unknown documents and null labels teach nothing; a document with several labels
is toxic if one says so, and so is a text that several documents share; without a positive every score is 0. Extra columns of
the documents are kept apart from the labels, which join on doc_id alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small
from .features import Linear, dense, telling
from .learning import Adam, by_text, sample, sigmoid

POSITIVES = 2000
UNLABELLED = 4000
FEATURES = 1024
CUT = 0.7
JUDGED = 100


@dataclass(frozen=True)
class Classifier:
    linear: Linear
    bias: float
    cut: float
    scale: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.linear.chosen):
            return np.zeros(len(texts))
        return self.place(self.linear.scores(texts)[0][:, 0] + self.bias)

    def place(self, z: np.ndarray) -> np.ndarray:
        return sigmoid((z - self.cut) * self.scale + np.log(CUT / (1 - CUT)))


NONE = Classifier(Linear(np.empty(0, np.uint32), np.empty((0, 1))), 0.0, 0.0, 1.0)


def nnpu_gradient(xp: np.ndarray, xu: np.ndarray, w: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Gradient of the non-negative risk for weights ``w`` (last one the bias), and that risk."""
    sp, su = sigmoid(xp @ w), sigmoid(xu @ w)
    dp, du = sp * (1 - sp), su * (1 - su)                # of sigmoid(z); loss(+) is 1 - s, loss(-) is s
    positive = -prior * (dp @ xp) / len(xp)
    negative_risk = su.mean() - prior * sp.mean()
    negative = (du @ xu) / len(xu) - prior * (dp @ xp) / len(xp)
    risk = prior * (1 - sp).mean() + max(0.0, negative_risk)
    return (positive + negative if negative_risk >= 0 else -negative), float(risk)


def best_cut(zp: np.ndarray, zu: np.ndarray, prior: float) -> float:
    """The cut of least estimated error: missed positives, plus flagged unlabelled text beyond the prior's share."""
    marks = np.unique(np.concatenate([zp, zu]))
    cuts = (marks[1:] + marks[:-1]) / 2
    if not len(cuts):
        return float(marks[0]) if len(marks) else 0.0
    hit = 1 - np.searchsorted(np.sort(zp), cuts) / len(zp)
    flagged = 1 - np.searchsorted(np.sort(zu), cuts) / len(zu)
    error = prior * (1 - hit) + np.abs(flagged - prior * hit)
    low = np.flatnonzero(error <= error.min() + 1 / len(zu))     # of equally good cuts, the one in the widest gap
    return float(cuts[low[np.argmax(marks[low + 1] - marks[low])]])


def fit(sets: list[np.ndarray], positive: np.ndarray, prior: float, epochs: int = 300, seed: int = 7,
        copies: np.ndarray | None = None) -> Classifier:
    """Train on feature sets, each standing for so many ``copies``; ``positive`` marks the confirmed ones. Every fourth row chooses the cut,
    or all rows where the positives are too few to keep some back."""
    if not positive.any() or positive.all():
        return NONE
    copies = np.ones(len(sets), np.int64) if copies is None else copies
    nth = np.empty(len(positive), np.int64)
    for side in (True, False):
        nth[positive == side] = np.arange((positive == side).sum())
    kept_back = (nth % 4 == 3) & (positive.sum() >= JUDGED)
    known = {s.tobytes() for s, p in zip(sets, positive) if p}
    apart = ~kept_back & np.array([p or s.tobytes() not in known for s, p in zip(sets, positive)])
    chosen = telling([s for s, k in zip(sets, apart) if k], positive[apart], FEATURES)
    if not len(chosen):
        return NONE
    x = np.column_stack([dense(sets, chosen), np.ones(len(sets), np.float32)])
    ip, iu = (np.flatnonzero(side & ~kept_back) for side in (positive, ~positive))
    ip, iu = np.repeat(ip, copies[ip]), np.repeat(iu, copies[iu])
    w, adam, rng = np.zeros(x.shape[1]), Adam(x.shape[1], 0.05), np.random.default_rng(seed)
    w[-1] = np.log(prior / (1 - prior))
    for _ in range(epochs):
        bp, bu = rng.integers(0, len(ip), min(512, len(ip))), rng.integers(0, len(iu), min(1024, len(iu)))
        gradient, _ = nnpu_gradient(x[ip[bp]], x[iu[bu]], w, prior)
        w = w - adam.step(gradient + 1e-5 * w)
    z = x @ w
    judged = kept_back if kept_back.any() else np.ones(len(z), bool)
    zp, zu = (np.repeat(z[side & judged], copies[side & judged]) for side in (positive, ~positive))
    cut = best_cut(zp, zu, prior)
    spread = max(1e-6, float(np.median(np.abs(zp - cut))))
    return Classifier(Linear(chosen, w[:-1, None]), float(w[-1]), cut, 3 / spread)


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Classifier:
    """Fit on the learning rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    marked = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    toxic = F.col("toxic") == 1
    texts = by_text(docs, marked, {1: toxic, 0: F.lit(True), 2: F.col("toxic").isNotNull()})
    confirmed, known = texts.agg(F.count("__pick1"), F.count("__pick2")).first()
    if not confirmed:
        return NONE
    sets, pick, copies = sample(docs, texts, {1: positives, 0: unlabelled})
    return fit(sets, pick == 1, min(confirmed / known, 1 - 0.5 / known), copies=copies)


def score(docs: DataFrame, model: Classifier, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in small(batches):
            scores = shared.value.score(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores), pa.array((scores >= CUT).astype(np.int32))],
                names=[*keep, "score", "predicted"])

    rows = docs.select(F.col(text).alias("__text"), *keep)
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[1:])
    return rows.mapInArrow(run, f"{types}score double, predicted int")
