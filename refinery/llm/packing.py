"""Best-fit packing: documents into as few fixed-size sequences as best-fit decreasing can.

A length is an integer up to the capacity, so the corpus enters the plan as a
histogram of at most ``capacity`` counts. The plan places equal lengths
together: a segment tree over the remaining capacities finds the tightest open
bin that takes the length in logarithmic time, and all bins of that remainder
are filled at once, which is what best-fit decreasing does one by one. Runs of
the plan say which ranks of a length go to which bins; tasks look their own
rows up, so no list of documents ever leaves the executors. The number of runs
depends on the capacity alone, not on the corpus.

Defined cases: a null or empty text is its end id alone; a document longer than
the capacity is cut into capacity-sized pieces, the first one shorter; repeated
rows and null ids are packed like any others; an empty table gives no rows.
Among pieces of one length the order of the written chunks decides.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .encode import END_ID, MEMO, TOKENIZER, encoder

CAPACITY = 2048
ROWS = 1024
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, "
          "chunk int, place long")


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity; a leaf counts its open groups of bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, remaining: int, by: int) -> None:
        node = remaining + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity >= ``least`` that has an open bin."""
        node = least + self.size
        if self.count[node]:
            return least
        while node > 1:                       # up to the first right sibling that holds something
            if not node & 1 and self.count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.size:               # and down to its leftmost leaf
            node *= 2
            if not self.count[node]:
                node += 1
        return node - self.size


@dataclass(frozen=True)
class Run:
    """Ranks first_rank.. of a length: ``per_bin`` pieces in each of ``bins`` bins, from ``offset`` on."""
    length: int
    first_rank: int
    per_bin: int
    bins: int
    first_bin: int
    offset: int


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Best-fit decreasing over a histogram of lengths."""
    tree, open_bins, runs, made = CapacityTree(capacity), {}, [], 0

    def put(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            open_bins.setdefault(remaining, []).append((first, n))
            tree.add(remaining, 1)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                new = -(-left // (capacity // length))
                put(capacity, made, new)
                made += new
                continue
            first, n = open_bins[room].pop()
            tree.add(room, -1)
            fit = room // length
            for bins, each in ((min(n, left // fit), fit), (1, left % fit if left < n * fit else 0)):
                if bins and each and left:
                    runs.append(Run(length, rank, each, bins, first, capacity - room))
                    put(room - each * length, first, bins)
                    rank, left = rank + bins * each, left - bins * each
                    first, n = first + bins, n - bins
            put(room, first, n)
    return runs


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER,
           end_id: int = END_ID, keep_ids: bool = False, memo: int = MEMO, unit: int | None = None) -> DataFrame:
    """Encode whole texts and cut them; ``chunk`` and ``place`` number equal lengths within a task."""

    def run(batches):
        enc, chunk = encoder(tokenizer, end_id, memo, unit=unit), TaskContext.get().partitionId()
        seen, rows = np.zeros(capacity + 1, np.int64), []

        def flush():
            columns = list(zip(*rows)) or [()] * len(schema)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for doc_id, coded in enc.documents(batches):
            ids = memoryview(coded)
            n, at, piece = len(ids) // 4, 0, 0
            while at < n:
                size = (n - at) % capacity or capacity
                part = ids[4 * at:4 * (at + size)]
                rows.append((doc_id, piece, at, size, zlib.crc32(part),
                             bytes(part) if keep_ids else None, chunk, int(seen[size])))
                seen[size] += 1
                at, piece = at + size, piece + 1
            if len(rows) >= ROWS:
                yield flush()
        yield flush()

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()),
                        ("chunk", pa.int32()), ("place", pa.int64())])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces whose (chunk, length, place) is fixed."""
    sizes = cut.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__base"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = best_fit_plan(counts, capacity)
    table = np.array([(r.length, r.first_rank, r.per_bin, r.first_bin, r.offset) for r in runs],
                     np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    first = np.searchsorted(table[:, 0], np.arange(capacity + 2))
    shared = cut.sparkSession.sparkContext.broadcast((table, first))

    def look_up(batches):
        plan, starts = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False)
            row = np.empty(len(rank), np.int64)
            for size in np.unique(length):      # the runs of a length stand together, by first rank
                mine = length == size
                lo, hi = starts[size], starts[size + 1]
                row[mine] = lo + np.searchsorted(plan[lo:hi, 1], rank[mine], "right") - 1
            run = plan[row]
            nth = rank - run[:, 1]
            keep = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(run[:, 3] + nth // run[:, 2]), pa.array(run[:, 4] + nth % run[:, 2] * length)],
                names=[*kept, "sequence_id", "offset"])

    kept = [c for c in cut.columns if c not in ("chunk", "place")]
    ranked = (cut.join(bases, ["chunk", "length"])
              .withColumn("__rank", F.col("place") + F.col("__base")).select(*kept, "__rank"))
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name in kept)
    return ranked.mapInArrow(look_up, types + ", sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID,
         keep_ids: bool = False, **memory: int) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Runs two jobs while it is called: the encoding, written to the shared folder,
    and the histogram of lengths. ``memo`` and ``unit`` bound the encoder's memory.
    """
    cut = written(pieces(docs, capacity, tokenizer, end_id, keep_ids, **memory), "pieces")
    if not keep_ids:
        cut = cut.drop("ids")
    return place(cut, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences themselves, from ``pack(..., keep_ids=True)``: at most a capacity each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("length"))
            .select("sequence_id", "length", F.aggregate(
                "p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
