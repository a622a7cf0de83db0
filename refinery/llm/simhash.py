"""SimHash near-dedup: fingerprints of word shingles, linked by tiled exact comparison.

1. Fingerprints are taken in one Arrow pass over whole texts.
2. Equal fingerprints are one node. Distinct ones are dealt into cells by the
   population counts of their four 16-bit quarters, at most 17^4 cells, and big
   cells into tiles of about ``TILE`` fingerprints by hash.
3. Two fingerprints within the radius differ in those four counts by at most
   the radius in sum, so a tile meets only tiles of cells that near; all other
   tile pairs are skipped. A pair of tiles is one row with two arrays, compared
   by numpy exclusive-or and bit counts in blocks.
4. A tile pair reports a spanning forest of its links, never all of them, and
   connected components run over those edges (alternating large-star and
   small-star joins, each round written to the shared folder).

The work is that of an exact all-pairs comparison less the skipped tiles: it
grows with the square of the number of distinct fingerprints.

Defined cases: null text is empty; a text without words has fingerprint zero and
links like any other; null doc_ids never name a component unless it has no
other (then component_id is null); repeated rows share a node; an empty table
gives no rows. Columns of the input keep their names in :func:`near_dedup`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, hold, small, with_row, written

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 4096
QUARTERS = 4
SLICE = 1 << 16


_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit-majority of the XXH64 of the word shingles, repeats included, as an unsigned integer.

    The text becomes one buffer of lower-case words with single blanks, in which
    a shingle is a slice; hashes are taken a slice of shingles at a time.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)   # bytes: ASCII only
    space = _SPACE[data]
    data = np.where(space, 32, data).astype(np.uint8)[~space | np.append(False, ~space[:-1])]
    joined = data.tobytes().rstrip(b" ")
    if not joined:
        return 0
    blanks = np.flatnonzero(data[:len(joined)] == 32)
    starts, ends = np.append(0, blanks + 1), np.append(blanks, len(joined))
    k = min(shingle, len(starts))
    n = len(starts) - k + 1
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, n, SLICE):
        slices = zip(starts[i:min(i + SLICE, n)].tolist(), ends[i + k - 1:i + k - 1 + SLICE].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in slices], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed 64-bit integer."""

    def run(batches):
        hold("simhash")
        for batch in small(batches):
            prints = np.array([fingerprint(t, shingle) for t in batch.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(prints.view(np.int64))], names=[*keep, "fp"])

    kept = docs.select(F.col(text).alias("__text"), *keep)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[1:])
    return kept.mapInArrow(run, f"{types}, fp long" if types else "fp long")


def _near_cells(radius: int) -> list[list[int]]:
    """Offsets between cells, one of each opposite pair, whose sum of absolute values is in the radius."""
    grid = np.stack(np.meshgrid(*[np.arange(-radius, radius + 1)] * QUARTERS, indexing="ij"), -1).reshape(-1, QUARTERS)
    near = [tuple(int(x) for x in o) for o in grid if np.abs(o).sum() <= radius]
    return [list(o) for o in near if o >= (0,) * QUARTERS]


def _spanning(left: np.ndarray, right: np.ndarray, radius: int, block: int = 256) -> list[tuple[int, int]]:
    """Links within the radius between two arrays, less those that other links of this pair imply."""
    both = np.unique(np.concatenate([left, right]))
    label = np.arange(len(both))
    li, ri = np.searchsorted(both, left), np.searchsorted(both, right)
    edges = []
    for i in range(0, len(left), block):
        near = np.bitwise_count(left[i:i + block, None] ^ right[None, :]) <= radius
        for a in np.flatnonzero(near.any(axis=1)):
            me, others = li[i + a], ri[near[a]]
            groups, first = np.unique(label[others], return_index=True)
            new = groups != label[me]
            if new.any():
                edges += [(int(both[me]), int(both[others[k]])) for k in first[new]]
                joined = np.append(groups, label[me])
                label[np.isin(label, joined)] = joined.min()
    return edges


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``) that connect what lies within the radius."""
    width = 64 // QUARTERS
    part = [F.bit_count(F.shiftrightunsigned("fp", q * width).bitwiseAND(F.lit((1 << width) - 1)))
            for q in range(QUARTERS)]
    cells = prints.select("fp", F.array(*part).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "tiles", F.ceil(F.col("n") / tile))
    # cells are at most 17^4 rows, so their table may be broadcast
    tiles = written(cells.join(F.broadcast(sizes.select("cell", "tiles")), "cell")
                    .withColumn("sub", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles")))
                    .groupBy("cell", "sub").agg(F.collect_list("fp").alias("fps"))
                    .withColumn("tile", F.concat_ws("-", F.col("cell").cast("array<string>"), F.col("sub"))), "tiles")
    ids = tiles.select("tile", "cell")
    near = F.explode(F.array(*[F.array(*[F.lit(x) for x in o]) for o in _near_cells(radius)]))
    reach = ids.withColumn("o", near).select(F.col("tile").alias("a"), F.zip_with(
        "cell", "o", lambda c, d: (c + d).cast("int")).alias("cell"), "o")
    same = F.forall("o", lambda x: x == 0)
    pairs = (reach.join(ids.select("cell", F.col("tile").alias("b")), "cell")
             .filter(~same | (F.col("a") <= F.col("b"))).select("a", "b"))
    left = tiles.select(F.col("tile").alias("a"), F.col("fps").alias("l"))
    right = tiles.select(F.col("tile").alias("b"), F.col("fps").alias("r"))
    meet = pairs.join(left, "a").join(right, "b").select("l", "r")

    def run(batches):
        hold("simhash")
        for batch in small(batches, 1):
            found = []
            for l, r in zip(batch.column(0), batch.column(1)):
                found += _spanning(l.values.to_numpy().view(np.uint64), r.values.to_numpy().view(np.uint64), radius)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    return meet.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node of its component.

    Alternates two star steps until the edge set stays as it is: large-star hangs
    the larger neighbours of a node on its smallest one, small-star the smaller
    ones. Minima are partial aggregates; the join back on a hub is split by Spark.
    """
    now = written(edges.select(F.greatest(u, v).alias("c"), F.least(u, v).alias("p"))
                  .filter("c != p").distinct(), "edges")

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("c", "p")), F.sum(F.xxhash64("c", "p") % 1000003)).first()

    before, here = None, state(now)
    while before != here:
        both = now.select(F.col("c").alias("x"), F.col("p").alias("y")).union(now.select("p", "c"))
        least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = (both.join(least, "x").filter("y > x").select(F.col("y").alias("c"), F.col("m").alias("p"))
                 .filter("c != p").distinct())
        low = large.groupBy("c").agg(F.min("p").alias("m"))
        hung = large.join(low, "c").filter("p != m").select(F.col("p").alias("c"), F.col("m").alias("p"))
        now = written(hung.union(low.select("c", F.col("m").alias("p"))).distinct(), "stars")
        before, here = here, state(now)
    return now.select(F.col("c").alias("node"), F.col("p").alias("root")).union(
        now.select(F.col("p"), F.col("p")).distinct())


def component_of_print(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``prints``; runs its jobs when called."""
    distinct = written(prints.select("fp").distinct(), "prints")
    found = components(links(distinct, radius, tile))
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable)."""
    taken = written(fingerprints(docs, shingle, keep=("doc_id",)), "fingerprints")
    firsts = taken.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = component_of_print(taken, radius).join(firsts, "fp")
    named = roots.join(roots.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "component_id")
    return taken.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` less all but one document of each component: the smallest doc_id stays
    (null ids last, then the row that comes first in the input files)."""
    rows = with_row(docs)
    taken = written(fingerprints(rows, shingle, keep=("doc_id", ROW)), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(ROW).alias("row"))
    bests = taken.groupBy("fp").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("n"))
    roots = component_of_print(taken, radius).join(bests, "fp")
    kept = roots.join(roots.groupBy("root").agg(F.min("best").alias("__stays"), F.sum("n").alias("__n")), "root")
    several = kept.filter("__n > 1").select("fp", F.col("__stays.row").alias("__stays"))
    dropped = taken.join(several, "fp").filter(F.col(ROW) != F.col("__stays")).select(ROW)
    return rows.join(dropped, ROW, "left_anti").select(*docs.columns)
