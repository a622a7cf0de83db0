"""Personal data: strict base rules, and candidates judged by gradient-boosted trees.

Base spans (e-mail, ip, card, phone) follow fixed rules and always stay. Beside
them, generators of high recall propose overlapping candidates: address-like
runs around an at sign, digit groups, assigned values and long mixed tokens.
Boosted trees judge a candidate by its format and context; they learn from the
candidates of all documents, by histograms that tasks sum up. The teachers are base spans, names
of assigned values and cue words before a candidate, and what a teacher goes by
is hidden from the trees: phones are shown without their plus sign and country
code too, addresses without the last part of their domain, values without their
name and words before them. So the trees find phones without a plus sign, or
keys in running text, which no teacher names. Candidates of a telling format that
no teacher judges are not taught as errors, but left out. Each kind has a
threshold for candidates with a cue and one for those without, calibrated on
candidates kept back whose cues are shown or hidden. Of overlapping accepted
candidates the likeliest stays. Added kinds (``address``, ``number``, ``secret``) never mix with the base
kinds' counts.

Candidates run to their delimiter, whatever their length; features look at the
first ``WIDTH`` characters. Matching whole texts stays linear: rules start from at signs, plus signs, digits
and assignment signs, not from every character.

Defined cases: null text is empty; empty texts have no spans; repeated rows each
get a result; an empty table, or one without candidates of both sorts, adds
nothing to the base spans; null doc_ids are kept and taught. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hold, small, written

BASE = ("email", "ip", "card", "phone")
ADDED = ("address", "number", "secret")
KINDS = (*BASE, *ADDED)
PRECISION = 0.95
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 32
UNIT = 1 << 20                                          # gradients are summed as integers in these parts of one
STEPS = 1 << 12                                         # thresholds tried between 0 and 1
LESSONS = 2_000                                         # rows of features a batch

Span = tuple[int, int, str]

# The base rules' patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")     # a run of digits is taken from its start or not at all
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_DIGIT = re.compile(r"[0-9]")
_GROUP = re.compile(r"[0-9]+")
_BETWEEN = re.compile(r"[ ().-]+")
_MIXED = re.compile(r"[A-Za-z0-9+/_-]{16,}")
_SIGN = re.compile(r"[=:]")
_NAME = re.compile(r"([A-Za-z_][A-Za-z0-9_-]{1,30})[\"']?\s?$")
_OPEN = re.compile(r"\s?[\"']?")
_VALUE = re.compile(r"[^\s\"',;]*")
_RUN = re.compile(r"\S*")
WIDTH = 128                                             # characters of a span that its features look at
_SECRET = re.compile(r"(?i)passw|pwd|secret|token|api_?key|access_?key|private_?key|credential")
_WORDS = ("mail", "phone", "call", "tel", "card", "ip", "host", "account", "id", "password", "token", "key", "secret")
# Words, numbers and paths made of them: mixed tokens that are no secrets.
_PLAIN = re.compile(r"(?:[A-Za-z]+|[0-9]+)(?:[/+_-]+(?:[A-Za-z]+|[0-9]+))*[/+_-]*")
_CUE = {"address": re.compile(r"(?i)\b(?:e-?mail|write to|contact|reach)\b[^@\n]{0,16}$"),
        "number": re.compile(r"(?i)\b(?:phone|tel|telephone|call|fax|mobile|ssn|social security|passport)\b[^0-9\n]{0,16}$"),
        "secret": re.compile(r"(?i)(?:passw(?:or)?d|secret|token|api.?key|access.?key|private.?key|credential)s?\b[^\n]{0,16}$")}
TELLING = 0.1                                           # share of taught candidates that makes a format of numbers telling


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, cross sums, total divisible by ten."""
    twice = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(int(d) for d in digits[-1::-2]) + twice) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end(), "email"
            end = m.end()
        at = text.find("@", max(end, at + 1))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The base spans of a text, by start, then by kind."""
    found = list(_emails(text))
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        found += [(m.start(), m.end(), "card") for m in _CARD.finditer(text)
                  if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=_order)


def _whole(span: tuple[int, int, str, str]) -> tuple[bool, int]:
    """Assigned values, the longest first, go before the pieces of them that are candidates too."""
    return not span[3], span[0] - span[1] if span[3] else 0


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[2]), span[1]


def runs(text: str) -> Iterator[tuple[int, int]]:
    """Neighbouring digit groups of 7 to 19 digits together, from every group's start, so they overlap."""
    groups = [m.span() for m in _GROUP.finditer(text)]
    near = [bool(_BETWEEN.fullmatch(text, a, b)) for (_, a), (b, _) in zip(groups, groups[1:])]
    for i, (lo, _) in enumerate(groups):
        lo -= text[lo - 1:lo] == "("
        lo -= text[lo - 1:lo] == "+"
        n = 0
        for j in range(i, len(groups)):
            n += groups[j][1] - groups[j][0]
            if n > 19 or j > i and not near[j - 1]:
                break
            if n >= 7:
                yield lo, groups[j][1]


def candidates(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, name of the assigned value or empty), overlapping ones too."""
    out, hi, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > hi and not text[lo - 1].isspace():
            lo -= 1
        hi = _RUN.match(text, at).end()
        if hi - lo > 4:
            out.append((lo, hi, "address", ""))
        at = text.find("@", hi)
    if _DIGIT.search(text):
        out += [(lo, hi, "number", "") for lo, hi in runs(text)]
        out += [(m.start(), m.end(), "secret", "") for m in _MIXED.finditer(text)
                if sum("0" <= c <= "9" for c in m[0]) >= 4 and any(c.isalpha() for c in m[0])]
    end = 0                                              # of the value that an earlier sign opened
    for m in _SIGN.finditer(text):
        name = _NAME.search(text[max(0, m.start() - 36):m.start()])
        if name:
            start = _OPEN.match(text, m.end()).end()
            end = end if start < end else _VALUE.match(text, start).end()
            if end - start >= 6:
                out.append((start, end, "secret", name[1]))
    return out


FEATURES = ("length", "digits", "letters", "upper", "marks", "distinct", "entropy", "hex share", "groups", "longest group",
            "first group", "second group", "last group", "before at", "dots after at", "letters after at", "dots", "checksum",
            "quoted", "space before", "space after", "glued before", "glued after", "joined before", "joined after",
            *ADDED, *_WORDS)


def features(text: str, start: int, end: int, kind: str, words: bool = True) -> list[float]:
    """Format of the span and its context, in the order of ``FEATURES``; ``words`` shows those before it."""
    s = text[start:min(end, start + WIDTH)]
    digits, n, groups = _digits(s), len(s), [len(g) for g in re.findall(r"[0-9]+", s)]
    counts = Counter(s)
    before, after = text[max(0, start - 32):start].lower(), text[end:end + 2]
    local, _, domain = s.partition("@") if kind == "address" else ("", "", "")
    return [end - start - (s[0] == "+"), len(digits), sum(c.isalpha() for c in s), sum(c.isupper() for c in s),
            sum(not c.isalnum() and c != "+" for c in s), len(counts), -sum(v / n * math.log2(v / n) for v in counts.values()),
            sum(c in "0123456789abcdefABCDEF" for c in s) / n, len(groups), max(groups, default=0),
            *(groups[:2] + [0, 0])[:2], groups[-1] if groups else 0,
            len(local), domain.count("."), sum(c.isalpha() for c in domain), s.count("."), 14 <= len(digits) <= 19 and luhn(digits),
            bool(before) and before[-1] in "\"'", not before or before[-1].isspace(), not after or after[0].isspace(),
            before[-1:].isalnum(), after[:1].isalnum(),
            before[-1:] in _TIGHT and before[-2:-1].isdigit(), after[:1] in _TIGHT and after[1:].isdigit(),
            *[kind == k for k in ADDED], *[words and w in before for w in _WORDS]]


_TIGHT = ("-", ".", "/")


def cued(text: str, span: tuple[int, int, str, str]) -> bool:
    """Whether a name or the words before it say what the candidate is."""
    start, _, kind, name = span
    return bool(name) or bool(_CUE[kind].search(text[max(0, start - 40):start]))


def _alone(text: str, start: int, end: int) -> bool:
    """No digit group is the candidate's neighbour."""
    return not (re.search(r"[0-9][ ().-]{0,4}$", text[max(0, start - 5):start]) or re.match(r"[ ().-]{0,4}[0-9]", text[end:end + 5]))


def taught(text: str, span: tuple[int, int, str, str], base: list[Span], named: bool = False) -> bool | None:
    """What the teachers say, None where they say nothing. ``named``: a piece of an assigned value."""
    start, end, kind, name = span
    if kind == "secret":
        if name:
            return bool(_SECRET.search(name))
        return None if named else True if cued(text, span) else False if _PLAIN.fullmatch(text, start, end) else None
    if kind == "address":
        return any(k == "email" and s >= start and e <= end and e - s >= 0.8 * (end - start) for s, e, k in base) or cued(text, span)
    for s, e, k in base:
        if k in ("ip", "card", "phone") and s < end and e > start:
            if s >= start and e <= end and e - s >= 0.8 * (end - start):
                return None if k == "ip" else True
            return None if k == "phone" and start > s and end == e else False
    if cued(text, span):
        return _alone(text, start, end)
    return False if start and text[start - 1] in _TIGHT or text[end:end + 1] in _TIGHT and text[end + 1:end + 2].isdigit() else None


def shown_less(text: str, base: list[Span]) -> Iterator[tuple[str, int, int, str]]:
    """(text, start, end, kind): base spans without the sign that their rule goes by, amid their context."""
    for s, e, kind in base:
        if kind == "phone":
            groups = [m.start() for m in _GROUP.finditer(text, s, e)]
            for at in (s + 1, *groups[1:2]):
                at -= at > s + 1 and text[at - 1] == "("
                if len(_digits(text[at:e])) >= 7:
                    yield text[max(0, s - 40):s] + text[at:e + 40], min(40, s), min(40, s) + e - at, "number"
        elif kind == "email":
            cut = text.rindex(".", s, e)
            if text.find(".", text.index("@", s, e), cut) >= 0 or cut - s > 4:
                yield text[max(0, s - 40):cut] + text[e:e + 40], min(40, s), min(40, s) + cut - s, "address"


def shape(s: str) -> str:
    """The lengths of a number's digit groups, or nothing where it has one group."""
    groups = [str(len(g)) for g in _GROUP.findall(s)]
    return "-".join(groups) if len(groups) > 1 else ""


def lessons(text: str) -> Iterator[tuple[int, int, str, bool | None, bool, str, list[float]]]:
    """(start, end, kind, label or None, cued, shape, features) of a text's candidates and base spans."""
    base, values = base_spans(text), 0
    for c in sorted(candidates(text), key=lambda c: (c[0], -c[1], not c[3])):
        start, end, kind, name = c
        y = taught(text, c, base, kind == "secret" and end <= values)
        values = max(values, end) if name else values
        if y is not None or kind == "number" and not any(s < end and e > start for s, e, _ in base):
            yield (start, end, kind, y, cued(text, c), shape(text[start:end]) if kind == "number" else "",
                   features(text, start, end, kind))
    for less, start, end, kind in shown_less(text, base):
        yield (start, end, kind, True, cued(less, (start, end, kind, "")), shape(less[start:end]) if kind == "number" else "",
               features(less, start, end, kind))


def wordless(x: np.ndarray) -> np.ndarray:
    """Features as they are without the words before the candidates."""
    return np.column_stack([x[:, :-len(_WORDS)], np.zeros((len(x), len(_WORDS)))])


@dataclass
class Trees:
    """Gradient-boosted trees of equal depth over binned features, for logistic loss.

    They grow from sums over all rows alone: gradients and hessians by node, column and bin.
    The sums are integers, so the trees do not depend on how rows are spread over tasks."""
    edges: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        """Grow on rows at hand."""
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
        bins, n = self.bins(x), np.ones(len(y))
        return self.grow(len(y), y.sum(), lambda column, cut, level: self.sums(bins, n, y, column, cut, level))

    def grow(self, n: int, good: int, sums: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> "Trees":
        """Trees for ``n`` rows, ``good`` of them of label 1; ``sums`` gives :meth:`sums` over all of them."""
        share = np.clip(good / n, 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        for _ in range(TREES):
            column, cut = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, BINS)
            value = np.zeros(2 ** DEPTH)
            for level in range(DEPTH):
                found = sums(column, cut, level) / UNIT
                for i in range(2 ** level):
                    at, (g, h) = 2 ** level - 1 + i, found[:, :, i].cumsum(axis=2)
                    column[at], cut[at] = self._split(g, h)
                    if level == DEPTH - 1:
                        lg, lh = g[column[at], cut[at]], h[column[at], cut[at]]
                        value[2 * i:2 * i + 2] = RATE * lg / (lh + 1), RATE * (g[0, -1] - lg) / (h[0, -1] - lh + 1)
            self.trees.append((column, cut, value))
        return self

    @staticmethod
    def _split(g: np.ndarray, h: np.ndarray) -> tuple[int, int]:
        """The column and bin whose cut gains most, by running sums a column; none gains: everything goes left."""
        lg, lh, whole, weight = g[:, :-1], h[:, :-1], g[0, -1], h[0, -1]
        gain = lg ** 2 / (lh + 1) + (whole - lg) ** 2 / (weight - lh + 1) - whole ** 2 / (weight + 1)
        j, k = np.unravel_index(int(gain.argmax()), gain.shape)
        return (int(j), int(k)) if gain[j, k] > 1e-6 else (0, BINS)

    @staticmethod
    def _node(bins: np.ndarray, column: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
        """Each row's node among those of a level, from the left."""
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            node = 2 * node + 1 + (bins[rows, column[node]] > cut[node])
        return node - (2 ** depth - 1)

    def chances(self, bins: np.ndarray) -> np.ndarray:
        z = np.full(len(bins), self.start)
        for column, cut, value in self.trees:
            z += value[self._node(bins, column, cut, DEPTH)]
        return 1 / (1 + np.exp(-z))

    def sums(self, bins: np.ndarray, n: np.ndarray, good: np.ndarray, column: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        """(gradient or hessian, column, node, bin) -> sum in parts of ``UNIT``, over distinct rows that each
        stand for ``n`` rows, ``good`` of them of label 1; nodes of a ``level`` of the next tree."""
        p, cells = self.chances(bins), 2 ** level * (BINS + 1)
        at = self._node(bins, column, cut, level) * (BINS + 1)
        parts = [np.rint(w * UNIT) for w in (good - n * p, n * p * (1 - p))]                 # exact in a double
        found = [[np.bincount(at + bins[:, j], w, cells) for j in range(bins.shape[1])] for w in parts]
        return np.array(found).astype(np.int64).reshape(2, bins.shape[1], 2 ** level, BINS + 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.chances(self.bins(x))


@dataclass(frozen=True)
class Model:
    trees: Trees | None
    threshold: dict[tuple[str, bool], float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Accepted candidates apart from the base spans and from each other, the likeliest first."""
        found = candidates(text) if self.trees else []
        if not found:
            return []
        p = self.trees.predict(np.array([features(text, *c[:3]) for c in found], float))
        taken, out = [(s, e) for s, e, _ in base], []
        for i in sorted(range(len(found)), key=lambda i: (*_whole(found[i]), -p[i], found[i])):
            s, e, kind, _ = found[i]
            if p[i] >= self.threshold[kind, cued(text, found[i])] and all(e <= a or s >= b for a, b in taken):
                taken.append((s, e))
                out.append((s, e, kind))
        return out

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans)."""
        base = base_spans(text)
        return base, sorted(base + self.added(text, base), key=_order)


NONE = Model(None, {})


def all_lessons(docs: DataFrame) -> DataFrame:
    """(kind, y, shape, shown, back, x) of the lessons of all documents; those ``back``, a quarter by hash, calibrate."""
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("y", pa.bool_()),
                        ("shown", pa.bool_()), ("shape", pa.string()), ("x", pa.list_(pa.float64()))])

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches):
        hold("pii")
        rows = []
        for batch in small(batches):
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for lesson in lessons(text or ""):
                    rows.append((i, *lesson))
                    if len(rows) == LESSONS:
                        yield packed(rows)
                        rows = []
        if rows:
            yield packed(rows)

    found = docs.select(F.xxhash64("doc_id").alias("id"), "text").mapInArrow(
        run, "id long, start long, end long, kind string, y boolean, shown boolean, shape string, x array<double>")
    return found.select("kind", "y", "shape", "shown", (F.pmod(F.xxhash64("id", "start", "end", "kind"), F.lit(4)) == 3).alias("back"), "x")


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` (y, shape, ...) without numbers that no teacher judges, in a format that taught numbers often have:
    they may be such numbers. Other numbers without a teacher's word are taught 0."""
    telling = (rows.filter("shape <> ''").groupBy(F.col("shape").alias("telling"))
               .agg(F.count(F.lit(1)).alias("n"), F.count_if("y").alias("good"))
               .filter((F.col("good") >= 3) & (F.col("good") >= F.lit(TELLING) * F.col("n"))).select("telling"))
    # at most 2^18 formats of 7 to 19 digits
    kept = rows.join(F.broadcast(telling), F.col("y").isNull() & (F.col("shape") == F.col("telling")), "left_anti")
    return kept.withColumn("y", F.coalesce("y", F.lit(False)))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def both(x: np.ndarray) -> np.ndarray:
    """Each candidate with the words before it and without them."""
    return np.concatenate([x, wordless(x)])


def coarse(x: np.ndarray) -> np.ndarray:
    """Values on a grid, three decimals or three digits, so that a column has a bounded number of them."""
    large = np.maximum(np.floor(np.log10(np.maximum(np.abs(x), 1))) - 2, -3)
    return np.where(large > 0, np.rint(x / 10 ** np.maximum(large, 0)) * 10 ** np.maximum(large, 0), np.round(x, 3))


def quantiles(values: np.ndarray, n: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Quantiles of ascending ``values`` that each occur ``n`` times, between neighbours by proportion."""
    ends = np.cumsum(n)
    at = q * (ends[-1] - 1)
    low = np.floor(at).astype(np.int64)
    a, b = (values[np.searchsorted(ends, np.minimum(i, ends[-1] - 1), "right")] for i in (low, low + 1))
    return a + (b - a) * (at - low)


def bin_edges(rows: DataFrame) -> list[np.ndarray]:
    """Edges of every feature's bins, from counts of the values of all ``rows`` (x)."""
    def run(batches):
        counts = [Counter() for _ in FEATURES]
        for batch in batches:
            x = coarse(both(matrix(batch.column(0))))
            for j, mine in enumerate(counts):
                mine.update(dict(zip(*(v.tolist() for v in np.unique(x[:, j], return_counts=True)))))
        for j, mine in enumerate(counts):
            yield pa.RecordBatch.from_arrays([pa.array([j] * len(mine), pa.int32()), pa.array(list(mine), pa.float64()),
                                              pa.array(list(mine.values()), pa.int64())], names=["column", "value", "n"])

    got = (rows.select("x").mapInArrow(run, "column int, value double, n long")
           .groupBy("column", "value").agg(F.sum("n").alias("n")).toPandas().sort_values(["column", "value"]))
    parts = {j: part for j, part in got.groupby("column")}
    q = np.linspace(0, 1, BINS)[1:-1]
    return [np.unique(quantiles(parts[j]["value"].to_numpy(), parts[j]["n"].to_numpy(), q)) for j in range(len(FEATURES))]


def binned(rows: DataFrame, trees: Trees) -> DataFrame:
    """(bins, n, good): distinct rows of bins among ``rows`` (x, y), how many there are and how many of label 1."""
    def run(batches):
        for batch in batches:
            bins = trees.bins(both(matrix(batch.column(0))))
            y = np.tile(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64), 2)
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(y)], names=["bins", "y"])

    return (rows.select("x", "y").mapInArrow(run, "bins binary, y long")
            .groupBy("bins").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")))


def grown(rows: DataFrame, trees: Trees, n: int, good: int) -> Trees:
    """``trees`` grown on ``rows`` (bins, n, good): a job a level, each partition of which sends its sums."""
    def sums(column: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        def run(batches):
            found = 0
            for batch in batches:
                bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, len(FEATURES))
                found = found + trees.sums(bins, *(batch.column(i).to_numpy() for i in (1, 2)), column, cut, level)
            if not isinstance(found, int):
                yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["sums"])

        parts = rows.select("bins", "n", "good").mapInArrow(run, "sums binary").toArrow()["sums"]
        return sum(np.frombuffer(p.as_py(), np.int64) for p in parts).reshape(2, len(FEATURES), 2 ** level, BINS + 1)

    return trees.grow(n, good, sums)


def thresholds(rows: DataFrame, trees: Trees) -> dict[tuple[str, bool], float]:
    """The least cut a kind, for candidates with a cue (those ``shown``) and, cues hidden, for those without,
    above which ``PRECISION`` of ``rows`` (kind, shown, y, x) are of label 1. Cuts are tried on a grid."""
    def run(batches):
        for batch in batches:
            kind, y = np.array(batch.column(0).to_pylist()), batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            shown, x = batch.column(1).to_numpy(zero_copy_only=False).astype(bool), matrix(batch.column(3))
            for cue, part, seen in ((True, shown, x), (False, np.ones(len(y), bool), wordless(x))):
                p = trees.predict(seen)
                part = part & (p >= 0.5)
                yield pa.RecordBatch.from_arrays([pa.array(kind[part].tolist(), pa.string()), pa.array([cue] * int(part.sum()), pa.bool_()),
                                                  pa.array(np.floor(p[part] * STEPS).astype(np.int32)), pa.array(p[part]), pa.array(y[part])],
                                                 names=["kind", "cue", "step", "p", "y"])

    got = (rows.select("kind", "shown", "y", "x").mapInArrow(run, "kind string, cue boolean, step int, p double, y long")
           .groupBy("kind", "cue", "step").agg(F.min("p").alias("cut"), F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).collect())
    found = {}
    for kind in ADDED:
        for cue in (True, False):
            found[kind, cue], n, good = math.inf, 0, 0
            for r in sorted((r for r in got if (r["kind"], r["cue"]) == (kind, cue)), key=lambda r: -r["step"]):
                n, good = n + r["n"], good + r["good"]
                if good >= 5 and good / n >= PRECISION:
                    found[kind, cue] = r["cut"]
    return found


def learn(docs: DataFrame) -> Model:
    """Fit on the candidates of all documents: three quarters, with and without the words before them, grow the
    trees, and the rest calibrates the thresholds."""
    rows = written(judged(written(all_lessons(docs), "lessons")), "taught")
    train = rows.filter("not back")
    n, good = train.agg(F.count(F.lit(1)), F.count_if("y")).first()
    if good in (0, n):
        return NONE
    trees = Trees(bin_edges(train))
    trees = grown(written(binned(train, trees), "binned"), trees, 2 * n, 2 * good)
    return Model(trees, thresholds(rows.filter("back"), trees))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, longest of overlapping ones, replaced by its kind."""
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if end > at:
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
            at = end
    return "".join(out) + text[at:]


def find(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), redact: bool = False) -> DataFrame:
    """``keep`` columns, a count a base kind, base_sha256, spans, and with ``redact`` the redacted text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("text").alias("__text"), *keep)

    def run(batches):
        hold("pii")
        for batch in small(batches):
            out = []
            for text in batch.column(0).to_pylist():
                base, every = shared.value.spans(text or "")
                n = Counter(k for _, _, k in base)
                out.append((*[n[k] for k in BASE], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every),
                            redacted(text or "", every) if redact else None))
            columns = list(zip(*out)) or [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *[pa.array(c, t) for c, t in zip(columns, types)]],
                                             names=[*keep, *[f"n_{k}" for k in BASE], "base_sha256", "spans", "redacted"])

    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[1:])
    found = rows.mapInArrow(run, f"{types}{', '.join(f'n_{k} long' for k in BASE)}, base_sha256 string, spans string, redacted string")
    return found if redact else found.drop("redacted")
