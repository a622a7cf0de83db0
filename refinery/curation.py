"""Curation as data: a spec names fields, references, rules, lookups; one run applies it.

Latest batch per source → standardized rows that keep their raw text → ordered
rules (first failing wins) → one observed write of accepted and rejected rows,
counted against the landed rows → quarantine with reason, provenance and raw
text → accepted rows with the attributes their lookups bring.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jobs
from .functions.text import Field, standardize
from .operators.rules import Rule, classify, flag_exists, flag_first, reason, with_row_id
from .sources import landing, raw


@dataclass(frozen=True)
class Lookup:
    """Left join to ``table`` on ``key``, bringing ``columns`` (new name → column of the table)."""
    table: str
    key: str
    columns: Mapping[str, str]


@dataclass(frozen=True)
class Spec:
    """``references`` maps a flag to (table, key): does the key exist there? ``rules`` are
    (reason, SQL predicate that holds for a failing row), which may use the flags."""
    fields: Sequence[Field]
    key: Sequence[str]
    references: Mapping[str, tuple[str, str]]
    rules: Sequence[tuple[str, str]]
    duplicate_reason: str
    priority: Sequence[str] = ("source_system", "source_file")
    lookups: Sequence[Lookup] = ()
    derived: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def raw_columns(self) -> list[str]:
        return [f.source or f.name for f in self.fields]


def incoming(spark: SparkSession, root: str, sources: Mapping[str, str], spec: Spec) -> DataFrame:
    """Newest batch of each source (system → dataset under ``root``), standardized, with raw text and row id."""
    parts = [standardize(with_row_id(raw.read_latest(spark, os.path.join(root, rel), spec.raw_columns)), list(spec.fields),
                         keep=["source_file", "_rid_file", "_rid_row"], literals={"source_system": system}, keep_raw=True)
             for system, rel in sources.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def classified(rows: DataFrame, tables: Mapping[str, DataFrame], spec: Spec, dedupe_scope: str = "all") -> DataFrame:
    """``rows`` with ``rejection_reason``. Duplicates are ranked over all rows, or with
    ``dedupe_scope="valid"`` over those that pass the other rules; the row id breaks ties."""
    for flag, (table, key) in spec.references.items():
        rows = flag_exists(rows, tables[table].select(key), [key], flag)
    rules = [Rule(name, F.expr(fails)) for name, fails in spec.rules]
    scope = None if dedupe_scope == "all" else reason(rules).isNull()
    rows = flag_first(rows, spec.key, list(spec.priority), ["_rid_file", "_rid_row"], flag="_first", scope=scope)
    return classify(rows, [*rules, Rule(spec.duplicate_reason, ~F.col("_first"))])


def enriched(rows: DataFrame, tables: Mapping[str, DataFrame], lookups: Sequence[Lookup]) -> DataFrame:
    """Left joins in order; a later lookup may use a column that an earlier one brought."""
    for n, look in enumerate(lookups):
        side = tables[look.table].select(F.col(look.key).alias(f"__key{n}"), *[F.col(c).alias(new) for new, c in look.columns.items()])
        rows = rows.join(side, rows[look.key] == side[f"__key{n}"], "left").drop(f"__key{n}")
    return rows


def run(spark: SparkSession, raw_root: str, out_root: str, name: str, sources: Mapping[str, str],
        tables: Mapping[str, DataFrame], spec: Spec, ingestion_ts: str, expected_rows: int | DataFrame | None = None) -> dict:
    """Run a spec; returns the reconciled counts. Writes ``classified/dq_status=…``, the DQ tables,
    ``rejected/<name>`` (CSV: values, raw text, reason, provenance) and ``curated/<name>``."""
    rows = classified(incoming(spark, raw_root, sources, spec), tables, spec)
    rows = rows.withColumn("ingestion_timestamp", F.lit(ingestion_ts).cast("timestamp"))
    provenance = ["source_file", "source_system", "ingestion_timestamp"]
    counts = jobs.curate(rows, out_root, columns=[*spec.columns, *provenance, "raw"], expected_rows=expected_rows)
    written = spark.read.parquet(os.path.join(out_root, "classified"))
    landing.write_quarantine(
        written.filter("dq_status = 'rejected'").select(
            *spec.columns, *provenance, "rejection_reason", *[F.col(f"raw.{c}").alias(f"raw_{c}") for c in sorted(set(spec.raw_columns))]),
        os.path.join(out_root, "rejected", name), fmt="csv")
    accepted = written.filter("dq_status = 'accepted'").select(*spec.columns, *provenance)
    curated = enriched(accepted, tables, spec.lookups).withColumns({c: F.expr(e) for c, e in spec.derived.items()})
    landing.write_curated(curated, os.path.join(out_root, "curated", name))
    return counts
