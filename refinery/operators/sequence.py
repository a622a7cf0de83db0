"""Skew-safe "nearest earlier / later row of the same key" lookups.

``lag``/``lead``/``last(ignorenulls)`` over ``Window.partitionBy(key)`` put
every row of a key into one task; one hot key holding a third of all rows
would make that task a third of the job. ``carry`` computes the same values
with bounded groups:

1. range-partition on ``(key…, order…)`` — a hot key spans many partitions
   because its order values differ — and write the result once as Parquet in
   the shared folder so the chunk number
   (partition id) of every row is fixed, also across task retries;
2. run the window inside ``(chunk, key)`` groups (at most one partition each);
3. aggregate the last present value of every ``(chunk, key)`` (one row per
   pair) and carry it across chunks with a window over that small table (a
   key has at most as many rows there as there are chunks);
4. join the cross-chunk value back on ``(chunk, key)``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize


def chunk_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   n_chunks: int | None = None, persist_input: bool = False) -> DataFrame:
    """Range-partition on (keys, order), number the partitions, materialize.

    The range sample and the write each compute ``df``; with ``persist_input``
    an expensive input is computed once (cached for the two jobs, released as
    soon as it is written). The jobs run when this is called.
    """
    src = df.persist() if persist_input else df
    cols = [F.col(c) for c in (*keys, *order)]
    # Without an explicit count AQE coalesces adjacent ranges to the advisory
    # partition size, so chunks follow the data volume (still contiguous ranges).
    ranged = src.repartitionByRange(n_chunks, *cols) if n_chunks else src.repartitionByRange(*cols)
    try:
        return materialize(ranged.withColumn("__chunk", F.spark_partition_id()), "chunks")
    finally:
        if persist_input:
            src.unpersist()


def carry(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
          present: Column | None = None, forward: bool = True, include_current: bool = False,
          prefix: str = "prev_", n_chunks: int | None = None, persist_input: bool = False) -> DataFrame:
    """Add ``prefix + v`` for each ``v`` in ``values``: the values of the nearest
    row of the same key before (``forward``) or after (backward) this one in
    ``order`` among rows where ``present`` holds (all rows by default).

    ``present`` = all rows, ``include_current=False`` is ``lag``/``lead``;
    a sparse ``present`` is an as-of lookup (last known value). ``order``
    columns must be non-NULL and should be a total order within a key.
    """
    pres = F.lit(True) if present is None else present
    # Input that already went through ``chunk_by_range`` (has ``__chunk``) is
    # reused as is: several passes over the same rows share one materialization.
    ch = df if "__chunk" in df.columns else chunk_by_range(df, keys, order, n_chunks, persist_input)
    # NULL-safe key columns (value-or-zero, is-null) used both to partition the
    # window and as plain equi-join keys, so the join back reuses the window's
    # partitioning instead of shuffling the rows a second time.
    nk = []
    for k in keys:
        ch = (ch.withColumn(f"__k_{k}", F.coalesce(F.col(k), zero_of(df.schema[k].dataType)))
              .withColumn(f"__kn_{k}", F.col(k).isNull()))
        nk += [f"__k_{k}", f"__kn_{k}"]
    ch = (ch.withColumn("__present", F.coalesce(pres, F.lit(False)))
          .withColumn("__val", F.when(F.col("__present"), F.struct(*[F.col(v).alias(v) for v in values]))))

    ords = [F.col(o) if forward else F.col(o).desc() for o in order]
    end = 0 if include_current else -1
    w_in = (Window.partitionBy("__chunk", *nk).orderBy(*ords)
            .rowsBetween(Window.unboundedPreceding, end))
    inner = ch.withColumn("__in", F.last("__val", ignorenulls=True).over(w_in))

    pick = F.max if forward else F.min
    tagged = F.when(F.col("__present"), F.struct(F.struct(*[F.col(o) for o in order]).alias("o"),
                                                 F.col("__val").alias("v")))
    per_chunk = ch.groupBy("__chunk", *nk).agg(pick(tagged).alias("__m"))
    w_x = (Window.partitionBy(*nk).orderBy(F.col("__chunk") if forward else F.col("__chunk").desc())
           .rowsBetween(Window.unboundedPreceding, -1))
    bridge = per_chunk.select("__chunk", *nk, F.last(F.col("__m.v"), ignorenulls=True).over(w_x).alias("__from"))
    joined = inner.join(bridge, ["__chunk", *nk], "left")
    res = F.coalesce(F.col("__in"), F.col("__from"))
    keep = list(df.columns)          # keeps __chunk only when the caller chunked
    return joined.select(*[F.col(c) for c in keep], *[res[v].alias(prefix + v) for v in values])


def zero_of(dt: T.DataType) -> Column:
    """A non-NULL stand-in of the key's type (paired with an is-null flag)."""
    if isinstance(dt, (T.NumericType,)):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dt)
    if isinstance(dt, T.BinaryType):
        return F.lit(bytearray())
    raise TypeError(f"unsupported key type for carry: {dt.simpleString()}")
