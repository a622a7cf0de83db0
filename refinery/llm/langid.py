"""Language ID by rank-order profiles (n-grams of one to three characters).

A profile is the list of a language's ``TOP`` most frequent n-grams. A document's
own list is compared with each profile by the out-of-place distance: for each of
its n-grams the difference of the two ranks, or ``TOP`` where the profile lacks
it. The language with the least distance is predicted.

Letters are lower-cased, everything else separates words, and words get a blank
on both sides, as n-grams of word starts and ends tell languages apart. An
n-gram is coded exactly in 63 bits (three code points), so counting is numpy on
whole texts, and ties of frequency are ranked by that code.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows with a null language teach nothing; equally near languages go by name; a
table that teaches no language predicts ``und``; repeated rows count as often as
they occur. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

TOP = 400
UNKNOWN = "und"
HELD = 2_000_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    cps = np.frombuffer(f" {text} ".lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    cps = np.where(_letters()[cps], cps, 32)
    cps = cps[np.append(True, (cps[1:] != 32) | (cps[:-1] != 32))]
    if len(cps) < 3:
        return np.empty(0, np.int64)
    one = cps[cps != 32]
    two = cps[:-1] << 21 | cps[1:]
    three = (cps[:-2] << 42 | cps[1:-1] << 21 | cps[2:])[cps[1:-1] != 32]
    return np.concatenate([one, two, three])


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    grams, place = np.unique(np.concatenate(codes), return_inverse=True)
    return grams, np.bincount(place, np.concatenate(counts), len(grams)).astype(np.int64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(codes ascending, counts) of a whole text."""
    found = [np.unique(_codes(s), return_counts=True) for s in common.stretches(text or "", common.STRETCH)]
    return found[0] if len(found) == 1 else merged([c for c, _ in found], [n for _, n in found])


def ranked(grams: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The ``top`` most frequent codes, most frequent first, equal counts by code."""
    return grams[np.argsort(-counts, kind="stable")[:top]]


@dataclass(frozen=True)
class Profiles:
    """``grams`` ascending; ``ranks[g, l]`` is the rank of gram g in language l, or ``top``."""
    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    top: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score); the score is 1 at distance 0 and 0 where no n-gram is known."""
        own = ranked(*gram_counts(text), self.top)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        place = np.where((self.grams[at] == own)[:, None], self.ranks[at], self.top)
        away = np.where(place == self.top, self.top, np.abs(place - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (self.top * len(own)))


def learn(docs: DataFrame, top: int = TOP, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of every language in ``docs``, from all its rows (``top`` rows a language reach the driver)."""

    def run(batches):
        common.hold("langid", _letters.cache_clear)
        held: dict[str, tuple[list, list]] = {}
        size = 0

        def flush():
            for name, (codes, counts) in held.items():
                c, n = merged(codes, counts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(c), pa.string()), pa.array(c), pa.array(n)],
                                                 names=["lang", "gram", "n"])

        for batch in common.small(batches):
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c, n = gram_counts(t)
                codes, counts = held.setdefault(name, ([], []))
                codes.append(c)
                counts.append(n)
                size += len(c)
                if size > HELD:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    totals = (rows.mapInArrow(run, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    found = totals.withColumn("r", place).filter(F.col("r") <= top).select("lang", "gram", (F.col("r") - 1).alias("r")).toPandas()
    langs = sorted(found["lang"].unique())
    grams = np.unique(found["gram"].to_numpy(np.int64))
    ranks = np.full((len(grams), len(langs)), top, np.int64)
    ranks[np.searchsorted(grams, found["gram"].to_numpy(np.int64)),
          np.searchsorted(langs, found["lang"].to_numpy(str)) if len(langs) else []] = found["r"].to_numpy(np.int64)
    return Profiles([str(x) for x in langs], grams, ranks, top)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and the score under the names ``out``; reads ``text`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    names, position = list(docs.columns), docs.columns.index(text)

    def run(batches):
        common.hold("langid", _letters.cache_clear)
        known = shared.value
        for batch in common.small(batches):
            said = [known.predict(t) for t in batch.column(position).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in said], pa.string()), pa.array([s for _, s in said], pa.float64())],
                names=[*names, *out])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{types}, `{out[0]}` string, `{out[1]}` double")
