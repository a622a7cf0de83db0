"""Soft-membership mixing: document rates whose expected domain tokens meet target shares.

1. A softmax classifier, learned from the labelled table, gives each document's
   posterior over the domains ``good``, ``poor`` and ``toxic``.
2. The rates r >= 0 solve the least squares problem S(r) = target, where
   S_k = sum_d r_d t_d p_dk / T are the shares of expected tokens (t_d tokens of a
   document, T of all, p_dk posteriors). Projected gradient from one copy each:

       r <- max(0, r - p W e),    e = S(r) - target

   the gradient of |e|^2 in the metric W. W is the inverse of the domains' Gram
   matrix, over the rows with a rate or (where that step does not go down) over all
   rows, so common and rare domains move alike and a few passes reach ``TOLERANCE``.
3. A step is K numbers, and a row's rate follows from the steps so far. So no pass
   writes rates: every task takes the steps anew over its rows and adds up K + K^2
   sums. It ends at ``TOLERANCE``, or where the gradient is nil (a domain without
   documents), after ``PASSES`` passes at most; shares that miss their target by
   more than ``MISSED`` are warned of. The shares are those of the rates returned.
4. Rate r becomes floor(r) copies and one more with probability r - floor(r),
   drawn from a hash of the row, so a rerun draws the same.

Tokens are runs of letters and digits or of punctuation marks.

Defined cases: null or empty texts have no tokens, rate 1 and one copy; null
labels teach nothing; an unseen domain has posterior 0; without labels every
posterior is the targets themselves and every rate 1; repeated rows get the same
rate and copies; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, written
from .features import Linear, dense, telling
from .learning import Adam, by_text, sample, softmax

DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.90, "poor": 0.07, "toxic": 0.03}
SAMPLE = 2500
FEATURES = 1024
TOLERANCE = 1e-6
PASSES = 60
MISSED = 0.002


@dataclass(frozen=True)
class Posterior:
    """Domain posteriors of texts; ``prior`` where nothing was learned."""
    linear: Linear
    bias: np.ndarray
    prior: np.ndarray

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(posteriors, tokens)."""
        z, tokens = self.linear.scores(texts)
        if not len(self.linear.chosen):
            return np.tile(self.prior, (len(texts), 1)), tokens
        return softmax(z + self.bias), tokens


def fit(sets: list[np.ndarray], label: np.ndarray, prior: np.ndarray, epochs: int = 200) -> Posterior:
    """Softmax regression on presence features; rows weigh as much as their domain's share."""
    seen = np.unique(label)
    none = Posterior(Linear(np.empty(0, np.uint32), np.zeros((0, len(prior)))), np.zeros(len(prior)), prior)
    if len(seen) < 2:
        return none
    chosen = np.unique(np.concatenate([telling(sets, label == k, FEATURES // len(seen)) for k in seen]))
    if not len(chosen):
        return none
    x = dense(sets, chosen)
    goal = np.eye(len(prior))[label]
    weigh = prior[label] / np.bincount(label, minlength=len(prior))[label]
    weigh = (weigh / weigh.sum())[:, None]
    w, b = np.zeros((x.shape[1], len(prior))), np.log(np.maximum(prior, 1e-9))
    by_w, by_b = Adam(w.shape, 0.05), Adam(b.shape, 0.05)
    for _ in range(epochs):
        off = weigh * (softmax(x @ w + b) - goal)
        w = w - by_w.step(x.T @ off + 1e-5 * w)
        b = b - by_b.step(off.sum(axis=0))
    return Posterior(Linear(chosen, w), b, prior)


def learn(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, size: int = SAMPLE) -> Posterior:
    """Learn the domains of labelled documents; at most ``size`` distinct texts a domain are sampled."""
    code = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1)
    marked = (labels.filter("doc_id is not null").groupBy("doc_id")
              .agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
              .select("doc_id", code.alias("label")).filter("label is not null"))
    counts = dict(docs.select("doc_id").join(marked, "doc_id").groupBy("label").count().collect())
    prior = np.array([counts.get(k, 0) for k in range(len(DOMAINS))], float)
    if not prior.sum():
        goal = np.array([targets[d] for d in DOMAINS])
        return fit([], np.empty(0, np.int64), goal / goal.sum())
    texts = by_text(docs, marked, {k: F.col("label") == k for k in sorted(counts)}, how="inner")
    sets, label, _ = sample(docs, texts, {k: size for k in sorted(counts)})
    return fit(sets, label, prior / prior.sum())


def posteriors(docs: DataFrame, model: Posterior, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, ``tokens`` and ``posterior`` (an array in the order of DOMAINS)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("text").alias("__text"), *keep)

    def run(batches):
        for batch in small(batches):
            p, n = shared.value.of(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(n), pa.array(list(p), pa.list_(pa.float64()))], names=[*keep, "tokens", "posterior"])

    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[1:])
    return rows.mapInArrow(run, f"{types}tokens long, posterior array<double>")


def rates(p: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Rates of rows with posteriors ``p`` after the projected gradient ``steps``."""
    r = np.ones(len(p))
    for step in steps:
        r = np.maximum(0, r - p @ step)
    return r


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def descend(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], goal: np.ndarray, tolerance: float = TOLERANCE,
            passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """(steps, shares): projected gradient steps from one copy each; ``sums(steps)`` is one pass over the rows.

    What goes down is |e|^2 in the metric of all rows. Steps in the metric of the rows with a rate come
    first, shorter ones after longer ones; where none goes down, one in the metric of all rows, which never
    goes up. It ends where that one does not go down either."""
    def inverse(gram: np.ndarray) -> np.ndarray:
        return np.linalg.pinv(gram, rcond=1e-9, hermitian=True)

    steps = np.zeros((0, len(goal)))
    shares, gram = sums(steps)
    left, whole = passes - 1, inverse(gram)
    while left > 0 and np.abs(e := shares - goal).max() > tolerance and (value := e @ whole @ e) > tolerance ** 2:
        own = inverse(gram)
        for w, length in ((own, 1), (own, 1 / 2), (own, 1 / 4), (own, 1 / 10), (whole, 1)):
            tried = np.vstack([steps, length * (w @ e)])
            now, left = sums(tried), left - 1
            off = now[0] - goal
            if (down := off @ whole @ off < value * (1 - 0.01 * length)) or left <= 0:
                break
        if not down:
            break
        steps, (shares, gram) = tried, now
    return steps, shares


def fit_rates(soft: DataFrame, targets: dict[str, float] = TARGETS, tolerance: float = TOLERANCE,
              passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """(steps, shares reached): one job a pass over the posteriors, K + K^2 numbers a task come back."""
    k = len(DOMAINS)
    goal = np.array([targets[d] for d in DOMAINS]) / sum(targets.values())
    total = soft.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return np.zeros((0, k)), goal

    def sums(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares that the rates after ``steps`` reach, and the Gram matrix of the rows with a rate."""
        def run(batches):
            out = np.zeros(k + k * k)
            for batch in batches:
                p, n = _matrix(batch.column(1), k), batch.column(0).to_numpy(zero_copy_only=False)
                r = rates(p, steps)
                some = p[r > 0]
                out += np.concatenate([(r * n) @ p, ((some * n[r > 0][:, None]).T @ some).ravel()])
            yield pa.RecordBatch.from_pylist([{"at": i, "part": x} for i, x in enumerate(out.tolist())])

        got = (soft.select("tokens", "posterior").mapInArrow(run, "at long, part double")
               .groupBy("at").agg(F.sum("part").alias("part")).collect())
        out = np.zeros(k + k * k)
        out[[r["at"] for r in got]] = [r["part"] for r in got]
        return out[:k] / total, out[k:].reshape(k, k) / total

    steps, shares = descend(sums, goal, tolerance, passes)
    missed = {d: (round(float(s), 4), round(float(g), 4)) for d, s, g in zip(DOMAINS, shares, goal) if abs(s - g) > MISSED}
    if missed:
        warnings.warn(f"mixing misses targets, (reached, target): {missed}", stacklevel=2)
    return steps, shares


def add_rates(soft: DataFrame, steps: np.ndarray) -> DataFrame:
    """``soft`` (with tokens and posterior) and the fitted ``rate``; a row without tokens has rate 1."""
    k, names = len(DOMAINS), soft.columns
    at = (names.index("tokens"), names.index("posterior"))

    def run(batches):
        for batch in batches:
            n = batch.column(at[0]).to_numpy(zero_copy_only=False)
            r = np.where(n > 0, rates(_matrix(batch.column(at[1]), k), steps), 1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(r)], names=[*names, "rate"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in soft.schema)
    return soft.mapInArrow(run, f"{types}, rate double")


def copies(rate, *identity):
    """floor(rate), and one more with the fraction's probability, drawn from a hash of the row."""
    draw = F.pmod(F.xxhash64(*identity), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return F.floor(rate + draw).cast("long")


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """Per row: doc_id, tokens, a posterior column a domain, rate and copies."""
    model = learn(docs, labels, targets)
    with_key = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("__draw"))
    soft = written(posteriors(with_key, model, ("doc_id", "__draw")), "posteriors")
    steps, _ = fit_rates(soft, targets)
    return add_rates(soft, steps).select(
        "doc_id", "tokens", *[F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate",
        copies(F.col("rate"), F.col("__draw")).alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``docs`` with each row repeated by its copies. Posteriors are taken again in the last
    pass over the texts, which gives the same values without a join."""
    model = learn(docs, labels, targets)
    steps, _ = fit_rates(written(posteriors(docs, model), "posteriors"), targets)
    whole = docs.withColumn("__all", F.struct(*docs.columns))
    rated = add_rates(posteriors(whole, model, ("__all",)), steps)
    n = copies(F.col("rate"), F.xxhash64(F.col("__all.doc_id"), F.col("__all.text")))
    return (rated.withColumn("__copies", n).filter("__copies > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
            .select("__all.*"))
