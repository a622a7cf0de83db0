"""Centroid clustering with ns-bounds: exact k-means rounds that rescan only what a bound cannot rule out.

A vector keeps, for every centroid, the squared distance that was last evaluated
and the round it was evaluated in. The centroids of all rounds are kept. In a
later round the stored distance is loosened by the norm of the centroid's total
displacement since that round (the triangle inequality; one norm, never the sum
of the drifts of the rounds between). A centroid whose loosened distance stays
above the distance to the vector's own centroid cannot be nearer; the others are
evaluated again, exactly. Distances are integers; the bounds are floats with a
margin beyond their rounding, so no nearer or equal centroid is ever ruled out.

Components are floor(scale * x) of the vector's x. A round is one pass over the
vectors in place, without a shuffle: state and vectors are written together, each
task adds up its clusters' components, and only K x width sums reach the driver.
Centroid history (rounds x K x width integers) is broadcast.

Defined cases: vectors without exactly ``width`` finite components are left out;
components beyond +-2^27 are held at that limit, so that a squared distance fits
into a long; repeated rows count as often as they stand there; a null vec_id
counts as the text ``null`` where starts are chosen; equal start hashes are
ordered by their components; fewer vectors than K give fewer centroids; ties go
to the smaller centroid number, and empty clusters keep their centroid; an empty
table gives no rows. ``cluster_inertia`` and ``inertia`` are null beyond a long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hold, small, written

K = 16
ROUNDS = 3
SCALE = 64
WIDTH = 64
LIMIT = 1 << 27
ROWS = 4096


def integer_vectors(vectors: DataFrame, scale: int = SCALE, width: int = WIDTH) -> DataFrame:
    """(vec_id, q): the vectors with ``width`` finite components, as integers floor(scale * x)."""
    x = F.col("embedding").cast("array<double>")
    whole = (F.size(x) == width) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    q = F.transform(x, lambda c: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(c * scale))).cast("int"))
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(F.col("vec_id"), q.alias("q"))


def starts(kept: DataFrame, k: int = K, salt: str = "1") -> np.ndarray:
    """The k vectors of the least sha256 of ``salt:vec_id``, in that order."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    first = kept.select(F.sha2(name, 256).alias("h"), "q").orderBy("h", "q").limit(k).collect()
    return np.array([r["q"] for r in first], np.int64)


def squared(q: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    off = q - centroid
    return np.einsum("ij,ij->i", off, off)


def assign(q: np.ndarray, history: np.ndarray, state: tuple[np.ndarray, np.ndarray, np.ndarray] | None
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, near, seen) of rows ``q`` under the last centroids of ``history``, and how many distances it took.

    ``near[i, j]`` is the squared distance to centroid j as of round ``seen[i, j]``;
    ``state`` holds the three of the round before (None: every distance is evaluated).
    """
    now, k = len(history) - 1, history.shape[1]
    if state is None:
        near = np.stack([squared(q, c) for c in history[now]], axis=1)
        return near.argmin(axis=1).astype(np.int32), near, np.full(near.shape, now, np.int8), near.size
    cluster, near, seen = (a.copy() for a in state)
    rows = np.arange(len(q))
    own = squared(q, history[now][cluster])
    near[rows, cluster], seen[rows, cluster] = own, now
    moved = np.sqrt(((history[now] - history).astype(float) ** 2).sum(axis=2))         # by round and centroid
    last, shift, reach = np.sqrt(near), moved[seen, np.arange(k)], np.sqrt(own)[:, None]
    margin = 1e-9 * (1 + last + shift + reach)
    fails = (last - shift - margin <= reach) & (seen < now)
    for j in np.flatnonzero(fails.any(axis=0)):
        again = np.flatnonzero(fails[:, j])
        near[again, j], seen[again, j] = squared(q[again], history[now][j]), now
    fresh = np.where(seen == now, near, np.iinfo(np.int64).max)
    return fresh.argmin(axis=1).astype(np.int32), near, seen, len(q) + int(fails.sum())


def _matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _rows(matrix: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(matrix.ravel()))


def assigned(table: DataFrame, history: np.ndarray, kind: str) -> DataFrame:
    """One round: ``table`` is (vec_id, q) or the table of the round before."""
    k, width = history.shape[1:]
    shared = table.sparkSession.sparkContext.broadcast(history)

    def run(batches):
        hold("nsbounds")
        for batch in small(batches, ROWS):
            q = _matrix(batch.column("q"), width)
            state = None if batch.num_columns == 2 else (
                batch.column("cluster").to_numpy(zero_copy_only=False), _matrix(batch.column("near"), k),
                _matrix(batch.column("seen"), k, np.int8))
            cluster, near, seen, _ = assign(q, shared.value, state)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("q"), pa.array(cluster), _rows(near), _rows(seen)],
                names=["vec_id", "q", "cluster", "near", "seen"])

    return table.mapInArrow(run, f"vec_id {kind}, q array<int>, cluster int, near array<bigint>, seen array<tinyint>")


def means(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise exact floor(sum / count) of each cluster; an empty one keeps its centroid."""
    k, width = centroids.shape

    def run(batches):
        sums, n = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in small(batches, ROWS):
            cluster, q = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), width)
            for j in np.unique(cluster):
                sums[j] += q[cluster == j].sum(axis=0)
            n += np.bincount(cluster, minlength=k)
        yield pa.RecordBatch.from_pylist([{"cluster": int(j), "sums": [int(n[j]), *sums[j].tolist()]} for j in np.flatnonzero(n)],
                                         pa.schema([("cluster", pa.int32()), ("sums", pa.list_(pa.int64()))]))

    total = (table.select("cluster", "q").mapInArrow(run, "cluster int, sums array<bigint>")
             .select("cluster", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at")
             .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect())
    whole = {(r["cluster"], r["at"]): int(r["total"]) for r in total}
    out = centroids.copy()
    for j in {c for c, _ in whole}:
        out[j] = [whole[j, d + 1] // whole[j, 0] for d in range(width)]
    return out


def clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, width: int = WIDTH,
             salt: str = "1") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) per kept vector, final centroids). Runs a job a round when called."""
    kept = written(integer_vectors(vectors, scale, width), "vectors")
    first = starts(kept, k, salt)
    kind = kept.schema["vec_id"].dataType.simpleString()
    if not len(first):
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), first
    history, table = first[None], kept
    for _ in range(rounds):
        table = written(assigned(table, history, kind), "round")
        history = np.concatenate([history, means(table, history[-1])[None]])
    last = assigned(table, history, kind)
    return written(last.select("vec_id", "cluster", F.element_at("near", F.col("cluster") + 1).alias("distance")),
                   "clusters"), history[-1]


def clustered(vectors: DataFrame, **options) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    rows, centroids = clusters(vectors, **options)
    names = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
    digests = rows.sparkSession.createDataFrame(names, "cluster int, centroid_sha256 string")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    each = rows.groupBy("cluster").agg(total.alias("__sum"))
    every = each.agg(F.sum("__sum").alias("__all"))                         # at most k rows, and one
    known = digests.join(each, "cluster", "left").join(F.broadcast(every))
    return rows.join(F.broadcast(known), "cluster").select(                 # k rows
        "vec_id", "cluster", "distance", F.col("__sum").try_cast("long").alias("cluster_inertia"),
        F.col("__all").try_cast("long").alias("inertia"), "centroid_sha256")
