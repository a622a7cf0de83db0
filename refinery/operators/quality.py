"""Quarantine split, DQ summary, constraint checks and reconciliation."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.expr import pass_rate


def split(classified: DataFrame, reason_col: str = "rejection_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted without the reason column, rejected with it)."""
    accepted = classified.filter(F.col(reason_col).isNull()).drop(reason_col)
    rejected = classified.filter(F.col(reason_col).isNotNull())
    return accepted, rejected


def summary(classified: DataFrame, reason_col: str = "rejection_reason") -> DataFrame:
    """One row: extracted, accepted, rejected, pass_rate (one pass, one job)."""
    r = F.col(reason_col)
    return (classified
            .agg(F.count(F.lit(1)).alias("extracted"),
                 F.count_if(r.isNull()).alias("accepted"),
                 F.count_if(r.isNotNull()).alias("rejected"))
            .withColumn("pass_rate", pass_rate("accepted", "extracted", 4)))


def by_reason(classified: DataFrame, reason_col: str = "rejection_reason",
              reasons: Sequence[str] | None = None, count_col: str = "rejected_count") -> DataFrame:
    """Rejections per reason; with ``reasons`` every listed reason appears (0 if unseen)."""
    counts = (classified.filter(F.col(reason_col).isNotNull())
              .groupBy(reason_col).agg(F.count(F.lit(1)).alias(count_col)))
    if reasons is None:
        return counts
    spark = classified.sparkSession
    names = spark.createDataFrame([(r,) for r in reasons], f"{reason_col} string")
    # full outer: a reason missing from the list is still reported, never dropped
    return (names.join(counts, reason_col, "full_outer")
            .select(reason_col, F.coalesce(F.col(count_col), F.lit(0).cast("bigint")).alias(count_col)))


def observe_counts(classified: DataFrame, reason_col: str = "rejection_reason",
                   name: str = "dq_counts") -> tuple[DataFrame, Observation]:
    """Attach row counters to ``classified``; they fill when the sink runs."""
    obs = Observation(name)
    r = F.col(reason_col)
    observed = classified.observe(obs, F.count(F.lit(1)).alias("extracted"),
                                  F.count_if(r.isNull()).alias("accepted"),
                                  F.count_if(r.isNotNull()).alias("rejected"))
    return observed, obs


class ReconciliationError(RuntimeError):
    pass


def reconcile(counts: Mapping[str, int], expected_extracted: int | None = None) -> dict:
    """Fail loudly unless extracted = accepted + rejected (and = landed rows when given)."""
    n, a, r = int(counts["extracted"]), int(counts["accepted"]), int(counts["rejected"])
    if n != a + r:
        raise ReconciliationError(f"extracted={n} != accepted={a} + rejected={r}")
    if expected_extracted is not None and n != expected_extracted:
        raise ReconciliationError(f"extracted={n} != landed={expected_extracted}")
    return {"extracted": n, "accepted": a, "rejected": r,
            "pass_rate": round(a / n, 4) if n else None}


def stage_counts(stages: Mapping[str, DataFrame], name_col: str = "table_name",
                 count_col: str = "row_count") -> DataFrame:
    """UNION ALL of one-row counts, one per named stage."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col))
             .select(F.lit(n).alias(name_col), F.col(count_col)) for n, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------ fault injection

@dataclass(frozen=True)
class Fault:
    """A labelled fault: rows matching ``where`` get ``overrides`` (or, with
    ``duplicate``, an appended copy), and ``label`` is the reason a correct
    classifier must give them."""
    label: str
    where: Column
    overrides: Mapping[str, Column] = field(default_factory=dict)
    duplicate: bool = False


def inject_faults(df: DataFrame, faults: Sequence[Fault], label_col: str = "expected_reason",
                  copy_col: str = "_copy") -> DataFrame:
    """Corrupt rows of ``df`` by the first matching fault; every row is kept.

    Override faults change the listed columns and carry the label; duplicate
    faults keep the original (unlabelled) and append a labelled copy with
    ``copy_col = 1``. Selection is by deterministic predicates, so the same
    input always yields the same labelled set.
    """
    lab = None
    for f in faults:
        lab = F.when(f.where, F.lit(f.label)) if lab is None else lab.when(f.where, F.lit(f.label))
    out = df.withColumn("__fault", lab)
    for f in faults:
        for col, expr in f.overrides.items():
            out = out.withColumn(col, F.when(F.col("__fault") == f.label, expr).otherwise(F.col(col)))
    dup_labels = [f.label for f in faults if f.duplicate]
    # Copies come from exploding a 1- or 2-element array: one pass over the
    # input, no union (and no second scan of it).
    is_dup = F.col("__fault").isin(*dup_labels) if dup_labels else F.lit(False)
    copies = F.when(is_dup, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = out.withColumn(copy_col, F.explode(copies))
    label = F.when(is_dup & (F.col(copy_col) == 0), F.lit(None).cast("string")).otherwise(F.col("__fault"))
    return out.withColumn(label_col, label).drop("__fault")


# ---------------------------------------------------------------- constraints

@dataclass(frozen=True)
class Constraint:
    name: str
    kind: str                      # pk | unique | not_null | max_length | check | fk
    cols: tuple = ()
    predicate: Column | None = None
    length: int | None = None
    parent: DataFrame | None = field(default=None, compare=False)
    parent_cols: tuple = ()


def primary_key(name: str, *cols: str) -> Constraint:
    return Constraint(name, "pk", tuple(cols))


def unique(name: str, *cols: str) -> Constraint:
    return Constraint(name, "unique", tuple(cols))


def not_null(name: str, col: str) -> Constraint:
    return Constraint(name, "not_null", (col,))


def max_length(name: str, col: str, n: int) -> Constraint:
    return Constraint(name, "max_length", (col,), length=n)


def check(name: str, predicate: Column | str) -> Constraint:
    """CHECK constraint: a row violates it only when the predicate is FALSE."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return Constraint(name, "check", (), predicate=p)


def foreign_key(name: str, cols: Sequence[str], parent: DataFrame, parent_cols: Sequence[str]) -> Constraint:
    return Constraint(name, "fk", tuple(cols), parent=parent, parent_cols=tuple(parent_cols))


def _row_violation(c: Constraint) -> Column:
    if c.kind == "not_null":
        return F.col(c.cols[0]).isNull()
    if c.kind == "max_length":
        return F.length(F.col(c.cols[0])) > F.lit(c.length)
    if c.kind == "check":
        return ~F.coalesce(c.predicate, F.lit(True))
    raise ValueError(c.kind)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Key groups holding more than one row (partial aggregation: skew-safe)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def fk_orphans(df: DataFrame, cols: Sequence[str], parent: DataFrame, parent_cols: Sequence[str]) -> DataFrame:
    """Child rows whose non-NULL key has no parent (anti join; NULL keys pass)."""
    # Distinct keys first: a hot parent key collapses map-side before the shuffle.
    right = parent.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(parent_cols)]).distinct()
    cond = None
    for i, c in enumerate(cols):
        term = df[c] == right[f"__p{i}"]
        cond = term if cond is None else cond & term
    notnull = None
    for c in cols:
        t = F.col(c).isNotNull()
        notnull = t if notnull is None else notnull & t
    return df.filter(notnull).join(right, cond, "left_anti")


def validate(df: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """One violation report ``(constraint, kind, violations)``.

    Row rules share one aggregate pass, all pk/unique rules share one scan and one
    shuffle, and each fk rule adds an anti join.
    """
    spark = df.sparkSession
    parts: list[DataFrame] = []
    row_rules = [c for c in constraints if c.kind in ("not_null", "max_length", "check")]
    if row_rules:
        agg = df.agg(*[F.count_if(_row_violation(c)).alias(f"v{i}") for i, c in enumerate(row_rules)])
        cells = [x for i, c in enumerate(row_rules) for x in (F.lit(c.name), F.lit(c.kind), F.col(f"v{i}"))]
        parts.append(agg.select(F.stack(F.lit(len(row_rules)), *cells).alias("constraint", "kind", "violations")))
    key_rules = [c for c in constraints if c.kind in ("pk", "unique")]
    if key_rules:
        # grouping sets: every row once a key, so all keys are counted by one scan and one shuffle of key and count
        cols = list(dict.fromkeys(k for c in key_rules for k in c.cols))
        sets = list(dict.fromkeys(tuple(k for k in cols if k in c.cols) for c in key_rules))
        counts = (df.groupingSets([[F.col(k) for k in s] for s in sets], *cols)
                  .agg(F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__set")))

        def violating(c: Constraint) -> Column:
            mine = sum(1 << (len(cols) - 1 - i) for i, k in enumerate(cols) if k not in c.cols)     # the columns left out
            null = F.lit(False)
            for k in c.cols:
                null = null | F.col(k).isNull()
            several = F.col("__n") > 1
            # a primary key has no NULL; SQL UNIQUE: NULLs never collide
            return F.when((F.col("__set") == mine) & ((null | several) if c.kind == "pk" else (~null & several)), F.col("__n"))

        bad = [violating(c) for c in key_rules]
        sums = counts.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(f"v{i}") for i, x in enumerate(bad)])
        cells = [x for i, c in enumerate(key_rules) for x in (F.lit(c.name), F.lit(c.kind), F.col(f"v{i}"))]
        parts.append(sums.select(F.stack(F.lit(len(key_rules)), *cells).alias("constraint", "kind", "violations")))
    for c in constraints:
        if c.kind == "fk":
            orphans = fk_orphans(df.select(*c.cols), list(c.cols), c.parent, list(c.parent_cols))
            parts.append(orphans.agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit(c.name).alias("constraint"), F.lit(c.kind).alias("kind"), "violations"))
    if not parts:
        return spark.createDataFrame([], "constraint string, kind string, violations bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("constraint", "kind", F.col("violations").cast("bigint").alias("violations"))
