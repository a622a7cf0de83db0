"""Hashed text features in numpy, and a bounded dense view of the telling ones.

Tokens are runs of letters and digits, or runs of punctuation; features are the
token and its first five to eight bytes. All tokens of a buffer are hashed at
once: a token's polynomial hash is a difference of running sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

from .common import hold

SIEVE = 1 << 20
BUFFER = 1 << 18
STEMS = (5, 6, 7, 8)
_P = 0x9E3779B97F4A7C15                    # odd, so it has an inverse modulo 2^64
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class of a byte (0 space, 1 word, 2 mark) and its lower-case value plus one."""
    kind = np.full(256, 1, np.uint8)
    for b in range(128):
        kind[b] = 1 if chr(b).isalnum() else 2
    kind[[*range(33), 127]] = 0
    value = np.arange(256, dtype=np.uint64)
    value[65:91] += np.uint64(32)
    return kind, value + np.uint64(1)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(n, BUFFER).bit_length()
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = tuple(np.cumprod(np.append(np.uint64(1), np.full(size, np.uint64(p), np.uint64)), dtype=np.uint64)
                              for p in (_P, pow(_P, -1, 1 << 64)))
    return _POWERS[size]


def _buffers(texts: Iterable[str | None]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Texts gathered to about BUFFER bytes, long ones cut at blanks, with their numbers."""
    parts, owners, size = [], [], 0
    for k, text in enumerate(texts):
        data, at = (text or "").encode("utf-8", "surrogatepass"), 0
        while at < len(data):
            cut = data.find(b" ", at + BUFFER) if len(data) - at > BUFFER else -1
            cut = cut if cut >= 0 else len(data)
            parts.append(data[at:cut])
            owners.append(k)
            size, at = size + cut - at, cut
            if size >= BUFFER:
                yield parts, owners
                parts, owners, size = [], [], 0
    if parts:
        yield parts, owners


def tokens(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, hash) of every token, buffer by buffer; then its stems' hashes."""
    hold("features", _POWERS.clear)
    kind, value = _tables()
    for parts, owners in _buffers(texts):
        data = np.frombuffer(b" ".join(parts), np.uint8)
        cls = kind[data]
        starts = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
        ends = np.append(starts[1:], len(data))
        word = cls[starts] != 0
        starts, ends = starts[word], ends[word]
        power, back = _powers(len(data))
        sums = np.append(np.uint64(0), np.cumsum(value[data] * power[:len(data)], dtype=np.uint64))
        first = np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]])
        owner = np.array(owners)[np.searchsorted(first, starts, "right") - 1]
        yield owner, (sums[ends] - sums[starts]) * back[starts] * _MIX
        for k in STEMS:
            long = ends - starts > k
            at = starts[long]
            yield owner[long], ((sums[at + k] - sums[at]) * back[at] + np.uint64(k)) * _MIX * _MIX


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """A feature's 32 bits."""
    return ((hashes ^ (hashes >> np.uint64(31))) * _MIX >> np.uint64(32)).astype(np.uint32)


def feature_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct features of each whole text, ascending."""
    seen = [np.empty(0, np.uint64)]
    for owner, hashes in tokens(texts):
        seen.append(np.unique(owner.astype(np.uint64) << np.uint64(32) | _mixed(hashes)))
    pairs = np.unique(np.concatenate(seen))
    owner = (pairs >> np.uint64(32)).astype(np.int64)
    return np.split(pairs.astype(np.uint32), np.searchsorted(owner, np.arange(1, len(texts))))


def find(features: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``features``, row of ``chosen``) of those that are chosen; ``chosen`` ascends."""
    at = np.searchsorted(chosen, features)
    hit = np.flatnonzero(at < len(chosen))
    hit = hit[chosen[at[hit]] == features[hit]]
    return hit, at[hit]


class Linear:
    """Sums of weight rows over the chosen features of whole texts."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray):
        self.chosen, self.weights = chosen, weights
        self.sieve = np.zeros(SIEVE, bool)
        self.sieve[chosen % SIEVE] = True

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(sums, number of tokens); a feature counts once a text."""
        n, width = len(texts), len(self.weights) + 1
        seen, counted = [np.empty(0, np.int64)], np.zeros(n, np.int64)
        for i, (owner, hashes) in enumerate(tokens(texts)):
            if i % (1 + len(STEMS)) == 0:
                counted += np.bincount(owner, minlength=n)
            features = _mixed(hashes)
            maybe = np.flatnonzero(self.sieve[features % SIEVE])
            hit, row = find(features[maybe], self.chosen)
            seen.append(np.unique(owner[maybe[hit]] * width + row))
        pairs = np.unique(np.concatenate(seen))
        out = np.zeros((n, self.weights.shape[1]))
        np.add.at(out, pairs // width, self.weights[pairs % width])
        return out, counted


def telling(sets: list[np.ndarray], is_class: np.ndarray, most: int, least_rows: int = 3) -> np.ndarray:
    """Features that the class has more often than the rest, best first by G statistic, at most ``most``."""
    inside = np.repeat(is_class, [len(s) for s in sets]).astype(bool)
    names, place, total = np.unique(np.concatenate([np.empty(0, np.uint32), *sets]), return_inverse=True, return_counts=True)
    a = np.bincount(place[inside], minlength=len(names)).astype(float)
    names, a, total = names[total >= least_rows], a[total >= least_rows], total[total >= least_rows]
    b = total - a
    na, nb = max(1, int(is_class.sum())), max(1, int((~is_class.astype(bool)).sum()))

    def part(x, n):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / n), 0)

    g = 2 * (part(a, na) + part(b, nb) + part(na - a, na) + part(nb - b, nb) - part(total, na + nb) - part(na + nb - total, na + nb))
    g[a / na <= b / nb] = 0
    best = np.argsort(-g, kind="stable")[:most]
    # above what the best of so many features reaches by chance
    return np.sort(names[best[g[best] > 2 * np.log(max(2, len(names)))]])


def dense(sets: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """Rows x chosen presence matrix."""
    x = np.zeros((len(sets), len(chosen)), np.float32)
    for i, s in enumerate(sets):
        x[i, find(s, chosen)[1]] = 1
    return x
