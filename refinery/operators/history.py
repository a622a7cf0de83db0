"""System-versioned history (SCD type 2), as-of reads and as-of joins."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources import buckets
from .cdc import after_images, normalise
from .sequence import carry, chunk_by_range

OPEN_END = "9999-12-31 00:00:00"


def scd2(log: DataFrame, keys: Sequence[str], order: Sequence[str], tracked: Sequence[str],
         valid_from: str = "valid_from", valid_to: str = "valid_to", open_end: str = OPEN_END,
         op: str | None = None) -> DataFrame:
    """Versions of ``tracked`` per key with half-open periods ``[valid_from, valid_to)``.

    A row starts a version when it is the key's first row or any tracked value
    differs (NULL-safe) from the previous row; ``valid_to`` is the next
    version's start, or ``open_end``. ``order[0]`` is the time column. With
    ``op`` the log's operations count (names or codes, before-images left out):
    a DELETE closes the key's period, and a later row opens a new one even if
    its values are the same.
    """
    time_col = order[0]
    if op is not None:
        log = after_images(log, op).withColumn("__live", F.col(op) != "DELETE")
    else:
        log = log.withColumn("__live", F.lit(True))
    # One range-partitioned materialization serves both passes (lag, then
    # "next change") because both run over the same rows.
    ch = chunk_by_range(log.select(*keys, *tracked, *order, "__live"), keys, order)
    prev = carry(ch, keys, order, [*tracked, time_col, "__live"], prefix="__p_")
    fresh = ~F.coalesce(F.col("__p___live"), F.lit(False))          # no row before, or it was deleted
    differs = fresh
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__p_{c}"))
    flagged = prev.withColumn("__changed", F.when(F.col("__live"), differs).otherwise(~fresh))
    nxt = carry(flagged, keys, order, [time_col], present=F.col("__changed"), forward=False, prefix="__n_")
    ttype = log.schema[time_col].dataType
    return (nxt.filter(F.col("__changed") & F.col("__live"))
            .select(*keys, *tracked, F.col(time_col).alias(valid_from),
                    F.coalesce(F.col(f"__n_{time_col}"), F.lit(open_end).cast(ttype)).alias(valid_to)))


def merge_history(batch: DataFrame, root: str, keys: Sequence[str], order: Sequence[str], tracked: Sequence[str],
                  batch_id: str, op: str | None = None, open_end: str = OPEN_END, **options) -> list[int]:
    """Take a batch of log rows into a stored history; only the buckets of its keys are rewritten.

    The store keeps the log rows of a bucket beside its versions, because a row that
    arrives late can split a closed period: what a later row of the same value said is
    needed again then. The touched buckets' versions are those of :func:`scd2` over
    their rows, so in whatever order batches come the history is that of the whole log.
    A row that is delivered again (all columns equal) counts once. Returns the
    rewritten buckets; a batch that was taken before changes nothing.
    """
    cols = [*keys, *order, *tracked, *([op] if op else [])]
    fresh = (normalise(batch, op) if op else batch).select(*cols)

    def merge(old: DataFrame, rows: DataFrame) -> dict[str, DataFrame]:
        log = materialize(old.unionByName(rows).distinct(), "history-log")
        return {"rows": log, "versions": scd2(log, keys, order, tracked, op=op, open_end=open_end)}

    return buckets.rewrite(fresh, root, keys, batch_id, fresh.schema, merge, **options)


def stored_history(spark, root: str, schema, load: int | None = None) -> DataFrame:
    """The versions that :func:`merge_history` keeps, as of a load; ``schema`` is that of :func:`scd2`'s result."""
    return buckets.read(spark, root, schema, "versions", load)


def as_of(history: DataFrame, t, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Versions valid at ``t``: ``valid_from <= t < valid_to`` (FOR SYSTEM_TIME AS OF)."""
    ts = F.lit(t).cast(history.schema[valid_from].dataType)
    return history.filter((F.col(valid_from) <= ts) & (ts < F.col(valid_to)))


def as_of_join(facts: DataFrame, history: DataFrame, keys: Sequence[str], fact_time: str,
               version_cols: Sequence[str], valid_from: str = "valid_from", valid_to: str = "valid_to",
               prefix: str = "version_", just_before: bool = False) -> DataFrame:
    """Each fact row with the version of its key in force at its time,
    ``valid_from <= fact_time < valid_to``, the period :func:`as_of` reads; with
    ``just_before`` the version in force before that instant,
    ``valid_from < fact_time <= valid_to`` (inner: facts without one are dropped).

    Not an equi-join with a range residual (that compares every fact with
    every version of a hot key): facts and versions are merged into one
    time-ordered stream per key and each fact carries the last version seen
    before it (``carry``), so work is linear in rows however skewed the keys.
    The order is total — time, versions against facts, end of the version, a hash
    of the fact — so the rows of one key at one instant spread over chunks too.
    """
    vcols = [*version_cols, valid_from, valid_to]
    end = F.lit(OPEN_END).cast(history.schema[valid_to].dataType)
    fact_kind, version_kind = (0, 1) if just_before else (1, 0)
    f = facts.select(*[F.col(c) for c in facts.columns],
                     F.col(fact_time).alias("__t"), F.lit(fact_kind).alias("__kind"), end.alias("__end"),
                     F.xxhash64(*facts.columns).alias("__h"),
                     *[F.lit(None).cast(history.schema[c].dataType).alias(f"__v_{c}") for c in vcols])
    fact_only = [c for c in facts.columns if c not in keys]
    v = history.select(*[F.col(k) for k in keys],
                       *[F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in fact_only],
                       F.col(valid_from).alias("__t"), F.lit(version_kind).alias("__kind"),
                       F.coalesce(F.col(valid_to), end).alias("__end"), F.lit(0).cast("bigint").alias("__h"),
                       *[F.col(c).alias(f"__v_{c}") for c in vcols])
    merged = f.unionByName(v)
    out = carry(merged, keys, ["__t", "__kind", "__end", "__h"], [f"__v_{c}" for c in vcols],
                present=F.col("__kind") == version_kind, prefix="__c")
    to = F.col(f"__c__v_{valid_to}")
    within = F.col("__t") <= to if just_before else F.col("__t") < to
    return (out.filter((F.col("__kind") == fact_kind) & F.col(f"__c__v_{valid_from}").isNotNull() & within)
            .select(*facts.columns, *[F.col(f"__c__v_{c}").alias(prefix + c) for c in vcols]))
