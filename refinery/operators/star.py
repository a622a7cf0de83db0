"""Star-schema loading: dense surrogate keys, dimensions, fact key lookup."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import quality


def assign_keys(df: DataFrame, order: Sequence[str], key_col: str, start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """Dense surrogate keys ``start, start+1, …`` following ``order`` (IDENTITY).

    Rows are range-partitioned on ``order`` and written once as Parquet in the
    shared folder, so the partition number is fixed even if tasks are retried;
    each partition's row count gives its offset (a table with one row per
    partition), and a window per partition numbers the rows inside it. AQE
    collapses a small input to one range. The write runs when this is called.
    """
    # no explicit count: AQE coalesces adjacent ranges to the advisory size
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ranged = materialize(ranged.withColumn("__pid", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"))
    within = F.row_number().over(Window.partitionBy("__pid").orderBy(*order))
    return (ranged.withColumn("__rn", within)
            .join(F.broadcast(offsets), "__pid")
            .withColumn(key_col, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__rn") + F.lit(start - 1))
                        .cast("bigint"))
            .drop("__pid", "__rn", "__off"))


def build_dimension(df: DataFrame, natural_key: Sequence[str], attrs: Sequence[str], key_col: str) -> DataFrame:
    """SELECT DISTINCT natural key + attributes, then a dense key in natural-key order.

    Conflicting attributes for one natural key give two rows (as DISTINCT
    does); ``natural_key_conflicts`` reports them before a fact fans out.
    """
    cols = list(natural_key) + [a for a in attrs if a not in natural_key]
    return assign_keys(df.select(*cols).distinct(), cols, key_col).select(key_col, *cols)


def natural_key_conflicts(dim: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    return quality.duplicate_keys(dim, natural_key)


ON_MISSING = ("drop", "unknown", "fail")


def resolve_keys(fact: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[tuple[str, str]], Sequence[str]]],
                 missing_col: str = "missing_lookup") -> DataFrame:
    """Every fact row with the columns its lookups bring, and the position of the
    first lookup that found nothing (NULL: all found).

    Each lookup is ``(dim, [(fact_col, dim_col), …], dim columns to bring)``;
    a later lookup may use columns an earlier one brought (snowflake chain).
    Join strategy is left to Catalyst/AQE: small dimensions broadcast under the
    threshold, large ones sort-merge.
    """
    out, missing = fact, F.lit(None).cast("int")
    for n, (dim, pairs, bring) in enumerate(lookups):
        right = dim.select(*[F.col(dc).alias(f"__d{i}") for i, (_, dc) in enumerate(pairs)], *bring,
                           F.lit(True).alias(f"__hit{n}"))
        cond: Column | None = None
        for i, (fc, _) in enumerate(pairs):
            term = out[fc] == right[f"__d{i}"]
            cond = term if cond is None else cond & term
        out = out.join(right, cond, "left").drop(*[f"__d{i}" for i in range(len(pairs))])
    for n in reversed(range(len(lookups))):
        missing = F.when(F.col(f"__hit{n}").isNull(), F.lit(n)).otherwise(missing)
    return out.withColumn(missing_col, missing).drop(*[f"__hit{n}" for n in range(len(lookups))])


def lookup_keys(fact: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[tuple[str, str]], Sequence[str]]],
                on_missing: str = "drop") -> DataFrame:
    """Resolve surrogate keys by a chain of equi-joins (see :func:`resolve_keys`).

    ``on_missing``: ``drop`` (rows without a match go, as an inner join has it),
    ``unknown`` (missing keys become -1), ``fail`` (the job fails on the first
    row without a match).
    """
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing is one of {ON_MISSING}, not {on_missing!r}")
    out = resolve_keys(fact, lookups, "__missing")
    if on_missing == "drop":
        return out.filter("__missing is null").drop("__missing")
    if on_missing == "fail":
        guard = F.when(F.col("__missing").isNull(), F.lit(True)).otherwise(F.raise_error(
            F.concat(F.lit("no match in lookup "), F.col("__missing").cast("string"))).cast("boolean"))
        return out.filter(guard).drop("__missing")
    for _, _, bring in lookups:
        for b in bring:
            if b.endswith("_key"):
                out = out.withColumn(b, F.coalesce(F.col(b), F.lit(-1).cast("bigint")))
    return out.drop("__missing")


def unmatched(fact: DataFrame, dim: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Fact rows an inner lookup would drop (anti join)."""
    return quality.fk_orphans(fact, [f for f, _ in pairs], dim, [d for _, d in pairs])


def extend_key_map(natural: DataFrame, natural_key: Sequence[str], key_col: str,
                   key_map: DataFrame | None = None) -> DataFrame:
    """Surrogate keys that stay stable across full refreshes.

    ``key_map`` (natural key → surrogate key) is carried between loads: known
    natural keys keep their key, new ones get keys after the current maximum
    (in natural-key order). Returns the extended map.
    """
    new = natural.select(*natural_key).distinct()
    if key_map is None:
        return assign_keys(new, natural_key, key_col).select(*natural_key, key_col)
    fresh = new.join(key_map.select(*natural_key), list(natural_key), "left_anti")
    offset = key_map.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("bigint")).scalar()
    keyed = assign_keys(fresh, natural_key, key_col).withColumn(key_col, F.col(key_col) + offset)
    return key_map.select(*natural_key, key_col).unionByName(keyed.select(*natural_key, key_col))
