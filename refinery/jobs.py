"""Composite jobs a user runs end to end: curate, land, load a star schema."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import quality, star
from .operators.rules import Rule, classify
from .session import materialize
from .sources import landing


def curate(classified_or_incoming: DataFrame, out_root: str, rules: Sequence[Rule] | None = None,
           columns: Sequence[str] | None = None, reason_col: str = "rejection_reason",
           expected_rows: int | DataFrame | None = None) -> dict:
    """Classify (unless already classified) → ONE observed write of all rows,
    partitioned into ``dq_status=accepted|rejected`` → reconcile the counts
    the write itself observed (raises on a mismatch, or when ``expected_rows``
    differs: the landing manifest's number, or the source rows themselves, which
    are counted before any join) → DQ summary and by-reason tables
    computed from what was written.

    Downstream readers take ``<out_root>/classified/dq_status=accepted`` as the
    curated zone and ``dq_status=rejected`` as the quarantine; the rejected
    rows keep their reason. Returns the reconciled counts.
    """
    cls = classify(classified_or_incoming, rules, reason_col) if rules is not None else classified_or_incoming
    cls, obs = quality.observe_counts(cls, reason_col)
    status = F.when(F.col(reason_col).isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
    cols = list(columns) if columns is not None else [c for c in cls.columns if not c.startswith("_")]
    if reason_col not in cols:
        cols.append(reason_col)
    landing.write_curated(cls.select(*cols, status.alias("dq_status")),
                          os.path.join(out_root, "classified"), partition_by=["dq_status"])
    expected = expected_rows.count() if isinstance(expected_rows, DataFrame) else expected_rows
    counts = quality.reconcile(obs.get, expected)
    spark = cls.sparkSession
    written = spark.read.parquet(os.path.join(out_root, "classified"))
    quality.summary(written, reason_col).write.mode("overwrite").parquet(os.path.join(out_root, "dq_summary"))
    quality.by_reason(written, reason_col).write.mode("overwrite").parquet(
        os.path.join(out_root, "dq_rejections_by_reason"))
    return counts


def land(spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame], raw_root: str, batch: str) -> DataFrame:
    """Land full extracts (and change logs) as batch-stamped CSV, write the
    manifest, and return the manifest reconciled against the landed files."""
    from .sources import raw
    mpath = landing.land_all(spark, tables, raw_root, batch)
    manifest = raw.read_manifest(spark, mpath)
    counted = landing.landed_counts(spark, raw_root, list(tables))
    return landing.reconcile_manifest(manifest, counted)


@dataclass
class Dimension:
    name: str
    source: DataFrame
    natural_key: Sequence[str]
    attrs: Sequence[str]
    key_col: str
    fact_on: Sequence[tuple[str, str]]          # (fact column, natural-key column)
    bring: Sequence[str] = field(default_factory=tuple)


def load_star(fact_rows: DataFrame, dims: Sequence[Dimension], out_root: str, fact_name: str = "fact",
              fact_cols: Sequence[str] | None = None, on_missing: str = "drop") -> DataFrame:
    """Dimensions first (distinct + dense surrogate keys), each written once;
    then the fact with keys resolved through them (a later dimension may join
    on a column an earlier one brought).

    A natural key with two attribute rows would double fact rows, so it raises.
    Fact rows without a match are written to ``<fact>_unmatched`` with the
    dimension that lacked them; ``drop`` leaves them out of the fact, ``unknown``
    keeps them with key -1, ``fail`` raises. Input rows have to equal fact rows
    and dropped rows. Returns the stage row counts read back from the written
    tables (the warehouse reconciliation query)."""
    if on_missing not in star.ON_MISSING:
        raise ValueError(f"on_missing is one of {star.ON_MISSING}, not {on_missing!r}")
    spark = fact_rows.sparkSession
    written = {}
    for d in dims:
        dim = star.build_dimension(d.source, d.natural_key, d.attrs, d.key_col)
        path = os.path.join(out_root, d.name)
        dim.write.mode("overwrite").parquet(path)
        written[d.name] = spark.read.parquet(path)
        conflict = star.natural_key_conflicts(written[d.name], d.natural_key).first()
        if conflict is not None:
            raise quality.ReconciliationError(f"{d.name}: several rows for natural key {conflict.asDict()}")
    lookups = [(written[d.name], list(d.fact_on), [d.key_col, *d.bring]) for d in dims]
    resolved = star.resolve_keys(fact_rows, lookups, "__missing").withColumn("__dropped", F.col("__missing").isNotNull())
    keys = [d.key_col for d in dims]
    names = F.array(*[F.lit(d.name) for d in dims])
    whole = resolved.withColumn("missing_dimension", F.get(names, F.col("__missing")))
    whole = whole.withColumns({k: F.coalesce(F.col(k), F.lit(-1).cast("bigint")) for k in keys}) if on_missing == "unknown" else whole
    cols = list(fact_cols) if fact_cols is not None else [c for c in resolved.columns if not c.startswith("__")]
    # one pass over the joins: matched and unmatched rows go to one staged table
    staged = materialize(whole.select(*cols, "missing_dimension", "__dropped"), "fact")
    unmatched = staged.filter("__dropped").drop("__dropped")
    fact = (staged if on_missing == "unknown" else staged.filter("not __dropped")).select(*cols)
    upath, fpath = os.path.join(out_root, f"{fact_name}_unmatched"), os.path.join(out_root, fact_name)
    unmatched.write.mode("overwrite").parquet(upath)
    if on_missing == "fail" and (first := spark.read.parquet(upath).first()) is not None:
        raise quality.ReconciliationError(f"no {first['missing_dimension']} row for {first.asDict()}")
    fact.write.mode("overwrite").parquet(fpath)
    stages = dict(written)
    stages[fact_name] = spark.read.parquet(fpath)
    n, kept = fact_rows.count(), stages[fact_name].count()
    dropped = spark.read.parquet(upath).count() if on_missing == "drop" else 0
    if n != kept + dropped:
        raise quality.ReconciliationError(f"fact rows in={n} != written={kept} + dropped={dropped}")
    return quality.stage_counts(stages)
