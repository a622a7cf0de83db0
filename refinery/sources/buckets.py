"""Keyed tables in hash buckets: a batch rewrites the buckets of its keys and commits by one small write.

Layout::

    <root>/data/load=<n>/<part>/bucket=<b>/   what load n wrote, the touched buckets alone
    <root>/versions/load=<n>/                 after load n: which load holds each bucket, and the batches taken

A load is visible once its folder under ``versions`` is complete (``_SUCCESS``), so
a writer that dies before leaves the version before it readable, and the next one
writes the same load again. Old loads stay until :func:`drop_unused`, and so does
every version that reads them. One writer at a time; any number of readers.

The number of buckets is fixed when the table begins. It bounds what reaches the
driver: the numbers of the touched buckets, and one row a bucket of the version.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import child_dirs, path_exists, remove_path

BUCKETS = 256
_VERSION = "bucket int, load long, buckets int, batches array<string>"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket number of a row; NULL keys have one like any other value."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def loads(spark: SparkSession, root: str) -> list[int]:
    """The committed loads, oldest first."""
    found = sorted(int(d.split("=")[1]) for d in child_dirs(spark, f"{root}/versions"))
    return [n for n in found if path_exists(spark, f"{root}/versions/load={n}/_SUCCESS")]


def _version(spark: SparkSession, root: str, load: int | None) -> tuple[int, dict[int, int], int | None, list[str]]:
    """(load, load of each bucket, number of buckets, batches taken); (-1, …) before the first."""
    done = [n for n in loads(spark, root) if load is None or n <= load]
    if not done:
        return -1, {}, None, []
    rows = spark.read.schema(_VERSION).json(f"{root}/versions/load={done[-1]}").collect()
    return (done[-1], {r["bucket"]: r["load"] for r in rows if r["bucket"] is not None}, rows[0]["buckets"],
            list(rows[0]["batches"]))


def _read(spark: SparkSession, root: str, part: str, held: Mapping[int, int], schema) -> DataFrame:
    paths = [f"{root}/data/load={n}/{part}/bucket={b}" for b, n in sorted(held.items())]
    paths = [p for p in paths if path_exists(spark, p)] if part != "rows" else paths
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, schema, part: str = "rows", load: int | None = None,
         buckets: Sequence[int] | None = None) -> DataFrame:
    """The table as of a load (default: the newest), or some of its buckets."""
    _, held, _, _ = _version(spark, root, load)
    return _read(spark, root, part, {b: n for b, n in held.items() if buckets is None or b in buckets}, schema)


def rewrite(batch: DataFrame, root: str, keys: Sequence[str], batch_id: str, schema,
            merge: Callable[[DataFrame, DataFrame], Mapping[str, DataFrame]], buckets: int = BUCKETS,
            before_commit: Callable[[], None] = lambda: None) -> list[int]:
    """Merge ``batch`` into the table and return the numbers of the buckets that were written.

    ``merge(old rows of the touched buckets, batch)`` gives the new rows of the touched
    buckets by part; ``rows`` (of ``schema``) is what the next merge gets as old rows. A
    batch whose id was taken before changes nothing.
    """
    spark = batch.sparkSession
    last, held, fixed, taken = _version(spark, root, None)
    if batch_id in taken:
        return []
    n = fixed or buckets
    touched = sorted(r["b"] for r in batch.select(bucket_of(keys, n).alias("b")).distinct().collect())   # n at most
    old = _read(spark, root, "rows", {b: held[b] for b in touched if b in held}, schema)
    load = last + 1
    for part, rows in merge(old, batch).items():
        # a rebalance sizes the files by volume: a small bucket is one file, a large one is split
        (rows.withColumn("bucket", bucket_of(keys, n)).hint("rebalance", "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/load={load}/{part}"))
    written = {int(d.split("=")[1]) for d in child_dirs(spark, f"{root}/data/load={load}/rows")}
    now = {b: l for b, l in held.items() if b not in touched} | {b: load for b in touched if b in written}
    before_commit()
    rows = [(b, l, n, [*taken, batch_id]) for b, l in sorted(now.items())] or [(None, load, n, [*taken, batch_id])]
    (spark.createDataFrame(rows, _VERSION).coalesce(1)                # at most a row a bucket
     .write.mode("overwrite").json(f"{root}/versions/load={load}"))
    return touched


def drop_unused(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Remove versions but the newest ``keep``, and loads that none of those reads; returns those loads."""
    done = loads(spark, root)
    used = {n for v in done[-keep:] for n in _version(spark, root, v)[1].values()}
    for v in done[:-keep]:
        remove_path(spark, f"{root}/versions/load={v}")
    gone = [n for n in done if n not in used]
    for n in gone:
        remove_path(spark, f"{root}/data/load={n}")
    return gone
