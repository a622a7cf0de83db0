"""Bounded labelled samples and small numpy learners over hashed features."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, written
from .features import feature_sets


DRAWS = 4


def by_text(docs: DataFrame, marked: DataFrame, conditions: dict[int, Column], key: str = "doc_id", how: str = "left") -> DataFrame:
    """A row a distinct text: its hash, and for each condition on the columns of ``marked`` the least key that meets it.

    ``marked`` has a row a key and meets the keys of ``docs`` alone, so no text is shuffled; equal texts are gathered by
    partial aggregates. Rows without a key are left out, and so are texts of a repeated key beyond one.
    """
    rows = (docs.select(key, F.xxhash64("text").alias("__hash")).filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.min("__hash").alias("__hash")).join(marked, key, how))
    return written(rows.groupBy("__hash").agg(*[F.min(F.when(c, F.col(key))).alias(f"__pick{p}") for p, c in conditions.items()]), "texts")


def sample(docs: DataFrame, texts: DataFrame, picks: dict[int, int], key: str = "doc_id") -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Feature sets of bounded samples of ``docs`` (key, text), their pick, and how many near copies each stands for.

    ``texts`` is of ``by_text``, and ``picks[p]`` is the most rows of condition p. The texts with the least hash of
    their key are drawn, so a sample does not depend on partitioning. Near copies within a pick leave the sample, and
    others are drawn until there are enough, or no more. The counts of near copies make the sample speak for all
    distinct texts. Only hashed features leave the tasks.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in small(batches):
            sets = feature_sets(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "sets"])

    want, last, kept = dict(picks), {}, {p: ([], np.empty(0)) for p in picks}
    while want:
        chosen = {}
        for p, n in want.items():
            rows = texts.select(F.xxhash64(f"__pick{p}").alias("o"), F.col(f"__pick{p}").alias("id"), "__hash").filter("id is not null")
            if p in last:
                o, i = last[p]
                rows = rows.filter((F.col("o") > o) | ((F.col("o") == o) & (F.col("id") > i)))
            chosen[p] = [tuple(r) for r in rows.orderBy("o", "id").limit(n).collect()]
        ids = sorted({(i, h) for part in chosen.values() for _, i, h in part})
        if not ids:
            break
        picked = docs.sparkSession.createDataFrame(ids, f"`{key}` {kind}, __hash long")
        got = (docs.select(key, "text", F.xxhash64("text").alias("__hash"))
               .join(F.broadcast(picked), [key, "__hash"])                     # at most DRAWS times the picks' sum of ids
               .select(F.col(key).alias("id"), "text").mapInArrow(run, f"id {kind}, sets binary")
               .dropDuplicates(["id"]).toArrow())
        of = {i: np.frombuffer(b, np.uint32) for i, b in zip(got["id"].to_pylist(), got["sets"].to_pylist())}
        for p, part in chosen.items():
            before = len(kept[p][0])
            sets, n = kept[p][0] + [of[i] for _, i, _ in part], np.append(kept[p][1], np.ones(len(part)))
            owner = owners(sets)
            own = np.flatnonzero(owner == np.arange(len(sets)))
            if len(own) >= picks[p]:                                           # later draws are not needed
                end = int(own[picks[p] - 1]) + 1 if picks[p] else 0
                sets, n, owner, own = sets[:end], n[:end], owner[:end], own[:picks[p]]
            kept[p] = [sets[i] for i in own], np.bincount(owner, n, len(sets))[own]
            missing = picks[p] - len(own)
            if missing <= 0 or len(part) < want[p]:
                del want[p]
            else:
                last[p] = part[-1][:2]
                want[p] = min(DRAWS * picks[p], 1 + 2 * missing * len(part) // max(1, len(own) - before))
    return ([s for sets, _ in kept.values() for s in sets], np.repeat(np.array(list(kept), np.int64), [len(s) for s, _ in kept.values()]),
            np.concatenate([np.empty(0), *[n for _, n in kept.values()]]).astype(np.int64))


def distinct_rows(sets: list[np.ndarray], alike: float = 0.5, bands: int = 4, width: int = 3) -> np.ndarray:
    """False for rows whose features mostly equal an earlier row's: copies would pass their words off as telling."""
    return owners(sets, alike, bands, width) == np.arange(len(sets))


def owners(sets: list[np.ndarray], alike: float = 0.5, bands: int = 4, width: int = 3) -> np.ndarray:
    """The earlier row whose features a row's mostly equal, or the row itself.

    Candidates share ``width`` minimum hashes in one of the ``bands``; their Jaccard similarity decides.
    """
    odd = np.random.default_rng(11).integers(1, 1 << 62, bands * width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    seen: dict[tuple, int] = {}
    owner = np.arange(len(sets))
    for i, s in enumerate(sets):
        if not len(s):
            continue
        least = ((s.astype(np.uint64) + np.uint64(1))[:, None] * odd >> np.uint64(20)).min(axis=0).reshape(bands, width)
        for b, signature in enumerate(least):
            j = seen.setdefault((b, *signature.tolist()), i)
            both = len(np.intersect1d(s, sets[j], assume_unique=True)) if j != i else 0
            if both >= alike * (len(s) + len(sets[j]) - both) and j != i:
                owner[i] = owner[j]
                break
    return owner


class Adam:
    """Step sizes from running means of a gradient and its square."""

    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient ** 2
        return self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)
