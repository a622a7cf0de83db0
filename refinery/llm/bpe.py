"""Byte-level BPE on Spark: ranked merges folded by higher-order functions, and decoding.

1. A text is split by the tokenizer's pattern. The corpus' distinct words are
   counted, and the most frequent ones, ``FREQUENT`` at most, are encoded once.
2. A word's bytes become an array of ids. A fold merges, step by step, the leftmost
   pair of the lowest rank until no pair has one; ranks come from a literal map
   (pair of ids -> id of both), in buckets because a Spark map is searched linearly.
3. The frequent words and their ids are broadcast. A text's words are looked up among
   them by :class:`Lookup`, an Arrow batch at a time; a word that is not there is merged
   where it stands (:class:`Merger`). Nothing but distinct words and counts is shuffled,
   and which words are frequent changes the time alone, never the ids.
4. Decoding puts the binary pieces of the ids together.

The literal tables (rank map, pieces) are one row, which reaches the expression as a
scalar subquery; their size depends on the vocabulary, that of the broadcast on
``FREQUENT`` words of at most ``WORD_BYTES`` bytes, not on the corpus. ``MEMO`` and
the encoder's ``UNIT`` bound what a worker holds besides.

Words that the JVM's Unicode tables split otherwise than the ``regex`` library are not
looked up. The scan for the lowest rank takes n^2 steps, so a word of more than ``LONG``
bytes is merged with a heap.

Defined cases: null or empty text has no ids; an id without a piece decodes to
nothing; repeated rows, ties and null doc_ids are encoded like any other; an empty
table gives no rows. Columns of the input keep their names.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hold, small, written
from .encode import _ODD, Encoder

RANKS = "byte_bpe_50k.tiktoken"
FREQUENT = 1 << 18
WORD_BYTES = 64
LONG = 256
MEMO = 300_000
PAIR_BUCKETS = 131_071
NONE = 2**31 - 1


def read_ranks(name: str = RANKS) -> dict[bytes, int]:
    """The file's byte strings and their ranks, which are their ids."""
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def pair_ranks(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """Every pair of ids whose bytes together have a rank."""
    return {(ranks[piece[:i]], ranks[piece[i:]]): rank for piece, rank in ranks.items()
            for i in range(1, len(piece)) if piece[:i] in ranks and piece[i:] in ranks}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


@dataclass(frozen=True)
class Tables:
    """The one-row DataFrame of literal tables, and expressions over its row."""
    row: DataFrame

    @staticmethod
    def of(spark: SparkSession, ranks: dict[bytes, int]) -> Tables:
        """pairs: rank by pair of ids, in buckets; first: rank by two bytes; singles: id by byte; pieces: hex by id."""
        buckets: list[dict[int, int]] = [{} for _ in range(PAIR_BUCKETS)]
        for (a, b), rank in pair_ranks(ranks).items():
            key = (a << 32) + b
            buckets[key % PAIR_BUCKETS][key] = rank
        pieces = [""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece.hex()
        first = [ranks.get(bytes([a, b]), NONE) for a in range(256) for b in range(256)]
        row = spark.createDataFrame([(buckets, first, [ranks.get(bytes([b])) for b in range(256)], pieces)],
                                    "pairs array<map<bigint,int>>, first array<int>, singles array<int>, pieces array<string>")
        return Tables(written(row, "ranks"))

    def with_ids(self, words: DataFrame) -> DataFrame:
        """``words`` (word) and their ``ids``, written."""
        return written(self.add(words.select("word"), "ids", lambda t, row: merged(t, row["word"])), "words")

    def add(self, df: DataFrame, name: str, body: Callable[[Column, Column], Column], keep: tuple[str, ...] | None = None) -> DataFrame:
        """``keep`` columns of ``df`` (all) and column ``name``, ``body`` over the tables' row and a row of ``df``.

        Row and tables are each used once, so the optimizer joins the projections and puts the subquery's
        value, a literal, straight into the expression: no row of ``df`` ever carries the tables."""
        held = df.select(F.struct(*df.columns).alias("__row"), self.row.select(F.struct("*")).scalar().alias("__tables"))
        names = df.columns if keep is None else keep
        out = let(F.col("__tables"), lambda t: let(F.col("__row"), lambda row: F.struct(
            *[row[c].alias(c) for c in names], body(t, row).alias(name))))
        return held.select(out.alias("__out")).select("__out.*")


def rank(tables: Column, a: Column, b: Column) -> Column:
    """Rank of two neighbouring ids together, ``NONE`` where they have none or one is null."""
    key = F.shiftleft(a.cast("long"), 32) + b
    return F.coalesce(let(key, lambda k: F.element_at(F.get(tables["pairs"], (k % PAIR_BUCKETS).cast("int")), k)), F.lit(NONE))


def merged(tables: Column, word: Column) -> Column:
    """Ids of one word: a fold over (pieces, ranks), where ranks[i] belongs to pieces i and i + 1."""
    def step(s: Column, _: Column) -> Column:
        def put(p: Column, r: Column, low: Column, i: Column) -> Column:
            left = F.when(i > 1, F.array(rank(tables, F.get(p, i - 2), low))).otherwise(F.array().cast("array<int>"))
            ranks = F.concat(F.slice(r, 1, F.greatest(i - 2, F.lit(0))), left,
                             F.array(rank(tables, low, F.get(p, i + 1))), F.slice(r, i + 2, F.size(r)))
            return F.struct(F.concat(F.slice(p, 1, i - 1), F.array(low), F.slice(p, i + 2, F.size(p))).alias("p"), ranks.alias("r"))

        p, r = s["p"], s["r"]
        return let(F.array_min(r), lambda low: F.when(low == NONE, s).otherwise(
            let(F.array_position(r, low).cast("int"), lambda i: put(p, r, low, i))))

    def fold(b: Column) -> Column:
        ranks = F.transform(b, lambda x, i: F.coalesce(F.get(tables["first"], x * 256 + F.get(b, i + 1)), F.lit(NONE)))
        pieces = F.transform(b, lambda x: F.get(tables["singles"], x))
        return F.aggregate(F.sequence(F.lit(1), F.size(b)), F.struct(pieces.alias("p"), ranks.alias("r")), step, lambda s: s["p"])

    text = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")                # one character a byte
    return let(F.transform(text, F.ascii), fold)


def split_words(text: Column) -> Column:
    """Matches of the pattern; ``(?U)`` gives white space its Unicode meaning."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern()), F.lit(0))


def frequent_words(texts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """(word): the most frequent distinct words of ``texts`` (column text), ``most`` at most; all rows are counted.

    The least count is chosen from a histogram of counts, so words are never sorted."""
    found = texts.select(F.explode(split_words(F.col("text"))).alias("word")).filter(F.octet_length("word") <= WORD_BYTES)
    counts = written(found.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    level = F.floor(8 * F.log2("n")).cast("int")
    taken, least = 0, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):   # at most 8 x 63 rows
        taken += r["count"]
        if taken > most:
            break
        least = r["level"]
    return counts.filter(F.lit(False) if least is None else level >= least).select("word")


class Merger:
    """Ids of whole texts by pattern; words by scans, long ones by heap and linked pieces."""

    def __init__(self, ranks: dict[bytes, int], split: str):
        import regex
        self.ranks, self.split = ranks, regex.compile(split)

    def pieces(self, data: bytes) -> list[bytes]:
        """What is left of ``data`` when no two neighbours have a rank together."""
        return self.scanned(data) if len(data) <= LONG else self.heaped(data)

    def scanned(self, data: bytes) -> list[bytes]:
        rank = self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = [rank(data[i:i + 2], NONE) for i in range(len(data) - 1)] + [NONE]  # ranks[i]: parts i and i + 1
        while (low := min(ranks)) != NONE:
            i = ranks.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            ranks[i] = rank(parts[i] + parts[i + 1], NONE) if i + 1 < len(parts) else NONE
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], NONE)
        return parts

    def heaped(self, data: bytes) -> list[bytes]:
        ends, before, after = [*range(1, len(data) + 1)], [*range(-1, len(data) - 1)], [*range(1, len(data) + 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(data) and (r := self.ranks.get(data[i:ends[j]])) is not None:
                heapq.heappush(heap, (r, i, ends[j]))

        for i in range(len(data)):
            offer(i)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i] if ends[i] else len(data)
            if j >= len(data) or ends[j] != end:                 # one of the two pieces has changed since
                continue
            ends[i], after[i], ends[j] = end, after[j], 0
            if after[j] < len(data):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [data[i:end] for i, end in enumerate(ends) if end]

    def word(self, data: bytes) -> list[int]:
        return [self.ranks[data]] if data in self.ranks else [self.ranks[p] for p in self.pieces(data)]

    def text(self, text: str | None) -> list[int]:
        return [i for m in self.split.finditer(text or "") for i in self.word(m.group().encode("utf-8", "surrogatepass"))]


class Lookup(Encoder):
    """``Encoder`` whose parts are looked up in ``words`` (word -> ids) and merged where they are not there."""

    def __init__(self, merger: Merger, words: dict[str, bytes], memo: int | None = None, unit: int | None = None):
        self.merger, self.words = merger, words
        # by part, as Encoder cuts them: without the blank before it, or after "\0"; runs of white space are no parts
        self.fixed = {w[1:] if w[0] == " " else w if w == "\n" else "\0" + w: ids for w, ids in words.items()
                      if "\0" not in w and (len(w) == 1 or not w.isspace())}
        self.odd, self.end = _ODD, b""
        self.most, self.unit = MEMO if memo is None else memo, unit
        self.memo, self.older, self.marks = {}, {}, {}

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        return np.array(self.merger.word(word.encode()), "<u4").tobytes() if ids is None else ids

    def whole(self, text: str) -> bytes:
        ids = self.words.get(text)
        return b"".join([self.word(m.group()) for m in self.merger.split.finditer(text)]) if ids is None else ids

    def _known(self, parts: list[str]) -> list[bytes]:
        table, get, new = [*map(self.fixed.get, parts)], self.memo.get, []
        for i, ids in enumerate(table):
            if ids is None:
                p = parts[i]
                if (ids := get(p)) is None:
                    if (ids := self.older.get(p)) is None:
                        ids = self.whole(p[1:] if p[:1] == "\0" else p if p == "\n" else " " + p)
                    new.append(i)
                table[i] = ids
        self._keep({parts[i]: table[i] for i in new})
        return table


def as_words(found: pa.Table, split) -> dict[str, bytes]:
    """Ids by word of ``found`` (word, ids), as far as ``split``, a compiled pattern, takes a word for one."""
    out: dict[str, bytes] = {}
    for batch in found.to_batches(max_chunksize=1 << 14):
        words, lists = batch.column("word").to_pylist(), batch.column("ids")
        ids, at = lists.flatten().to_numpy().astype("<u4"), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
        out |= {w: ids[a:b].tobytes() for w, a, b in zip(words, at[:-1], at[1:]) if w.isascii() or split.fullmatch(w)}
    return out


@lru_cache(maxsize=1)
def _merger(name: str) -> Merger:
    return Merger(read_ranks(name), pattern())


_lookups: dict[str, Lookup] = {}      # by key of the words, one at most


def _lookup(name: str, key: str, words: Broadcast) -> Lookup:
    """One a worker process, as long as it encodes with these words."""
    hold("bpe", lambda: (_lookups.clear(), _merger.cache_clear()))
    if key not in _lookups:
        _lookups.clear()
        with pa.ipc.open_stream(words.value) as stream:
            _lookups[key] = Lookup(_merger(name), as_words(stream.read_all(), _merger(name).split))
    return _lookups[key]


def looked_up(words: DataFrame, name: str = RANKS) -> Callable[[Column], Column]:
    """Ids of texts, of which ``words`` (word, ids) are broadcast; a null text has none."""
    sink = pa.BufferOutputStream()
    found = words.select("word", "ids").toArrow()
    with pa.ipc.new_stream(sink, found.schema) as stream:
        stream.write_table(found)
    sent, key = words.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes()), uuid.uuid4().hex

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            lookup = _lookup(name, key, sent)
            one = pa.RecordBatch.from_arrays([texts], ["text"])
            found = [*lookup.encode_all(t for part in small([one]) for t in part.column(0).to_pylist())]
            starts = np.append(0, np.cumsum([len(x) >> 2 for x in found])).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(starts), pa.array(np.frombuffer(b"".join(found), "<i4")))
    return ids


def encode(docs: DataFrame, keep: tuple[str, ...], name: str = RANKS, frequent: int = FREQUENT) -> tuple[DataFrame, Tables]:
    """(``keep`` columns of ``docs`` and ``ids`` of column text, the literal tables).

    Counts the words when called; the encoding itself moves no rows."""
    tables = Tables.of(docs.sparkSession, read_ranks(name))
    words = tables.with_ids(frequent_words(docs.select("text"), frequent))
    return docs.select(*[F.col(c) for c in keep], looked_up(words, name)(F.col("text")).alias("ids")), tables


def decode(coded: DataFrame, tables: Tables, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` and column ``out``, the bytes of its array of ids."""
    held = coded.select("*", tables.row.select("pieces").scalar().alias("__tables"))
    return held.select(*coded.columns, let(F.col("__tables"), lambda pieces: F.unhex(F.array_join(
        F.transform(F.col(ids), lambda i: F.get(pieces, i)), ""))).alias(out))


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (decimal ids joined by a blank), decoded_sha256."""
    coded, tables = encode(docs, ("doc_id",), **options)
    return decode(coded, tables).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
