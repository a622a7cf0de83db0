"""Incremental processing with Structured Streaming file sources.

``trigger(availableNow=True)`` processes everything new since the last
checkpoint and stops: the checkpoint is the high-water mark, so a second run
reads only files that arrived since, and a crashed run resumes from the last
committed micro-batch.
"""

from __future__ import annotations

import os
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import live, normalise, stored_fold, stored_last_state
from ..session import child_dirs


def land_incremental(spark: SparkSession, src: str, schema: T.StructType, sink: str, checkpoint: str,
                     fmt: str = "parquet", transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Copy new files of ``src`` to the ``sink`` (exactly once through the file sink log)."""
    stream = spark.readStream.schema(schema).format(fmt).load(src)
    if transform is not None:
        stream = transform(stream)
    q = (stream.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def foreach_batch_classify(spark: SparkSession, src: str, schema: T.StructType, sink: str, checkpoint: str,
                           classify: Callable[[DataFrame, DataFrame | None], DataFrame],
                           seen_cols: Sequence[str], fmt: str = "parquet") -> None:
    """Run a batch classifier over each new micro-batch and write its result to
    ``sink/batch_id=<n>`` (overwrite: a replayed batch replaces itself).

    ``classify(batch, seen)`` gets the ``seen_cols`` keys of all earlier
    batches (a static side, e.g. for duplicate detection across batches).
    Those keys live in a compact table next to the sink
    (``<sink>_keys/batch_id=<n>``, only keys new in that batch), so each batch
    reads a table that grows with distinct keys, not with rows.
    """
    keys_root = sink.rstrip("/") + "_keys"

    def process(batch: DataFrame, batch_id: int) -> None:
        seen = None
        if child_dirs(spark, keys_root):
            seen = spark.read.parquet(keys_root).filter(F.col("batch_id") < batch_id).select(*seen_cols)
        out = classify(batch, seen).withColumn("batch_id", F.lit(batch_id))
        out.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))
        written = spark.read.parquet(os.path.join(sink, f"batch_id={batch_id}")).select(*seen_cols).distinct()
        new_keys = written if seen is None else written.join(seen.distinct(), list(seen_cols), "left_anti")
        new_keys.write.mode("overwrite").parquet(os.path.join(keys_root, f"batch_id={batch_id}"))

    q = (spark.readStream.schema(schema).format(fmt).load(src).writeStream
         .foreachBatch(process).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def land_once(spark: SparkSession, src: str, schema: T.StructType, sink: str, checkpoint: str, keys: Sequence[str],
              event_time: str, delay: str, fmt: str = "parquet",
              transform: Callable[[DataFrame], DataFrame] | None = None, files_per_batch: int | None = None) -> dict:
    """Copy new files of ``src`` to ``sink`` and leave out rows whose ``keys`` came before, in this or an earlier batch.

    The state store keeps the keys of the last ``delay`` of event time alone (the watermark is the latest event time
    less ``delay``), so the state is bounded by the arrival rate and not by history. Two promises of the source are
    needed: a repeat comes within ``delay`` of its first copy, and no row comes more than ``delay`` after a later one.
    A row that breaks the second is older than the watermark and cannot be told from a repeat; it is left out and
    counted. Returns ``state_rows`` held at the end and ``late_rows`` left out in this run. Where the source promises
    neither, use :func:`foreach_batch_classify`, whose key table grows with distinct keys.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(src)
    if transform is not None:
        stream = transform(stream)
    mark = "__event_time"
    once = (stream.withColumn(mark, F.col(event_time).cast("timestamp")).withWatermark(mark, delay)
            .dropDuplicatesWithinWatermark(list(keys)).drop(mark))
    q = (once.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    states = [s for p in q.recentProgress for s in p["stateOperators"]]
    return {"state_rows": states[-1]["numRowsTotal"] if states else 0,
            "late_rows": sum(s["numRowsDroppedByWatermark"] for s in states)}


def _batch_ids(spark: SparkSession, root: str, part: str) -> list[int]:
    return sorted(int(d.split("=")[1]) for d in child_dirs(spark, root) if d.startswith(f"{part}="))


def foreach_batch_apply(spark: SparkSession, src: str, schema: T.StructType, state_root: str, checkpoint: str,
                        keys: Sequence[str], image: Sequence[str],
                        to_log: Callable[[DataFrame], DataFrame] | None = None,
                        lsn: str = "lsn", seq: str = "seq", op: str = "operation", fmt: str = "parquet",
                        compact_every: int = 10) -> None:
    """Apply a change-log stream to a keyed state table, merge-on-read.

    Each micro-batch writes only its own changes to
    ``state_root/changes/batch_id=<n>`` (O(batch), overwrite: a replayed batch
    rewrites itself, and applying the same changes twice gives the same
    state). Every ``compact_every`` batches a snapshot
    ``state_root/snapshot/upto=<n>`` folds the changes into the state, deleted
    keys and their (lsn, seq) included, so a change that arrives late loses to
    what it is older than, whichever batch brought that. Readers use
    :func:`latest_state`: newest snapshot + later changes, last operation per
    key; the result does not depend on ``compact_every``. State as of any batch
    stays readable while its changes are kept.
    """
    cols = [*keys, *image, lsn, seq, op]

    def process(batch: DataFrame, batch_id: int) -> None:
        changes = to_log(batch) if to_log is not None else batch
        normalise(changes, op).select(*cols).write.mode("overwrite").parquet(
            os.path.join(state_root, "changes", f"batch_id={batch_id}"))
        if (batch_id + 1) % compact_every == 0:
            _state(spark, state_root, keys, image, lsn, seq, op, batch_id) \
                .write.mode("overwrite").parquet(os.path.join(state_root, "snapshot", f"upto={batch_id}"))

    q = (spark.readStream.schema(schema).format(fmt).load(src).writeStream
         .foreachBatch(process).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _state(spark: SparkSession, state_root: str, keys: Sequence[str], image: Sequence[str],
           lsn: str, seq: str, op: str, upto: int | None) -> DataFrame:
    """Last change per key up to batch ``upto``, deletes included: newest snapshot and later changes."""
    changes_root = os.path.join(state_root, "changes")
    snaps = [v for v in _batch_ids(spark, os.path.join(state_root, "snapshot"), "upto") if upto is None or v <= upto]
    if not _batch_ids(spark, changes_root, "batch_id"):
        raise FileNotFoundError(f"no state under {state_root}")
    deltas = spark.read.parquet(changes_root)
    if snaps:
        deltas = deltas.filter(F.col("batch_id") > snaps[-1])          # partition pruning
    if upto is not None:
        deltas = deltas.filter(F.col("batch_id") <= upto)
    deltas = deltas.drop("batch_id")
    if not snaps:
        return stored_last_state(deltas, keys, image, lsn, seq, op)
    base = spark.read.parquet(os.path.join(state_root, "snapshot", f"upto={snaps[-1]}"))
    return stored_fold(base, deltas, keys, image, lsn, seq, op)


def latest_state(spark: SparkSession, state_root: str, keys: Sequence[str], image: Sequence[str],
                 lsn: str = "lsn", seq: str = "seq", op: str = "operation", upto: int | None = None) -> DataFrame:
    """State after batch ``upto`` (default: all batches) written by :func:`foreach_batch_apply`:
    one row per live key with its image and the lsn and seq of its last change."""
    return live(_state(spark, state_root, keys, image, lsn, seq, op, upto), op).select(*keys, *image, lsn, seq)
