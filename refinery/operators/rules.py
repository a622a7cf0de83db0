"""Ordered data-quality rules: the first failing rule names the rejection reason.

Rules are plain Catalyst predicates (``True`` means the row fails). A NULL
predicate falls through to the next rule, exactly as a CASE WHEN chain does.
Referential checks are left joins to distinct parent keys (no fan-out
whatever the parent holds); the duplicate rule is computed skew-safely
(see ``flag_first``, and ``flag_first_once`` which shuffles rows once).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .sequence import zero_of


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def _cols(cols: Iterable[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def any_null(*cols: Column | str) -> Column:
    """OR of IS NULL over ``cols`` (the required-field rule)."""
    cs = _cols(cols)
    out = cs[0].isNull()
    for c in cs[1:]:
        out = out | c.isNull()
    return out


def reason(rules: Sequence[Rule]) -> Column:
    """CASE chain over ``rules``; NULL when every rule passes."""
    out = F.when(rules[0].fails, F.lit(rules[0].name))
    for r in rules[1:]:
        out = out.when(r.fails, F.lit(r.name))
    return out


def classify(df: DataFrame, rules: Sequence[Rule], reason_col: str = "rejection_reason") -> DataFrame:
    """Add ``reason_col`` = name of the first failing rule (NULL = accepted)."""
    return df.withColumn(reason_col, reason(rules))


def flag_exists(df: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str],
                flag: str) -> DataFrame:
    """Add boolean ``flag``: does a parent row with the same key exist?

    A left join to the parent's *distinct* keys: duplicate parent keys cannot
    multiply child rows, a small parent is broadcast (size-checked by Spark's
    threshold, measured again by AQE at run time), and a large one is
    sort-merge joined where AQE can split a hot child key across tasks (it
    cannot split an ExistenceJoin, the plan an EXISTS subquery gets).
    ``on`` holds ``(child_col, parent_col)`` pairs or shared names; NULL child
    keys never match.
    """
    pairs = [(p, p) if isinstance(p, str) else p for p in on]
    tag = uuid.uuid4().hex[:8]
    pnames = [f"__p{i}_{tag}" for i in range(len(pairs))]
    right = (parent.select(*[F.col(pc).alias(n) for (_, pc), n in zip(pairs, pnames)])
             .distinct().withColumn(f"__hit_{tag}", F.lit(True)))
    cond = None
    for (cc, _), n in zip(pairs, pnames):
        term = df[cc] == right[n]
        cond = term if cond is None else cond & term
    return (df.join(right, cond, "left")
            .withColumn(flag, F.coalesce(F.col(f"__hit_{tag}"), F.lit(False)))
            .drop(*pnames, f"__hit_{tag}"))


def with_row_id(df: DataFrame, prefix: str = "_rid") -> DataFrame:
    """Deterministic per-row identity: (hash of file path, row index).

    Unlike ``monotonically_increasing_id`` it does not depend on how the scan
    is split, so a recomputed task after an executor loss gets the same ids.
    Formats without a row index (CSV, JSON) are written once as Parquet in the
    shared folder and get the identity of the written row, which every later
    pass reads.
    """
    def named(d: DataFrame) -> DataFrame:
        return d.select("*", F.xxhash64(F.col("_metadata.file_path")).alias(f"{prefix}_file"),
                        F.col("_metadata.row_index").alias(f"{prefix}_row"))
    try:
        out = named(df)
        out.schema                                   # analysis decides whether the scan has a row index
        return out
    except AnalysisException:
        return named(materialize(df, "rows"))


def flag_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
               row_id: Sequence[str], flag: str = "is_first",
               scope: Column | None = None, last: bool = False) -> DataFrame:
    """``flag`` = row is first of its key group by ``order`` (row_number() == 1).

    Keys are counted first, by a hash aggregate over the key columns alone, in
    which a hot key costs one row per map task. Only rows of keys that occur
    more than once are ranked, by ``min(struct(order..., row_id))``, and the
    winner's row id comes back by one join on the key, which AQE splits where a
    key is hot. A row of a key without a winner is the only one, so it is first.
    ``row_id`` columns also break exact ties, so exactly one row per group is
    first. NULL keys form one group, as in a window. With ``scope`` only rows
    matching it compete (rows outside it are never first). ``last=True`` flags
    the last row instead (row_number() over descending order == 1).
    """
    tag = uuid.uuid4().hex[:8]
    # NULL-safe key columns (value-or-zero, is-null): plain equi-join keys, so that the
    # aggregates and joins below share one partitioning
    names, safe = [], df
    for i, k in enumerate(keys):
        safe = (safe.withColumn(f"__k{i}_{tag}", F.coalesce(F.col(k), zero_of(df.schema[k].dataType)))
                .withColumn(f"__n{i}_{tag}", F.col(k).isNull()))
        names += [f"__k{i}_{tag}", f"__n{i}_{tag}"]
    competing = F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
    order_cols = [c.alias(f"__o{i}") for i, c in enumerate(_cols(order))]
    candidates = safe.filter(competing)
    several = candidates.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    rank = F.struct(*order_cols, F.struct(*[F.col(r).alias(r) for r in row_id]).alias("__id"))
    winners = (candidates.select(*names, rank.alias("__rank")).join(several, names, "left_semi")
               .groupBy(*names).agg((F.max if last else F.min)("__rank").alias("__m"))
               .select(*names, F.col("__m.__id").alias(f"__id_{tag}")))
    won = F.col(f"__id_{tag}")
    mine = F.lit(True)
    for r in row_id:
        mine = mine & (F.col(r) == won[r])
    return (safe.join(winners, names, "left")
            .withColumn(flag, competing & (won.isNull() | mine))
            .select(*df.columns, flag))


HOT = 100_000                     # rows of one key that one task may sort


def flag_first_once(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], row_id: Sequence[str],
                    flag: str = "is_first", by: Sequence[str] | None = None,
                    then: Callable[[DataFrame], DataFrame] = lambda rows: rows, hot: int = HOT) -> DataFrame:
    """``flag_first`` of ``then(df)`` with one shuffle of the rows.

    ``then`` may add columns or repeat rows, as a lookup does; every copy of the first
    row is first. ``by`` (default: ``keys``) are those of the keys that its join goes by, so
    the rows lie by them already and a window ranks them where they lie. A window sorts all rows
    of a ``by`` in one task; those of a ``by`` with more than ``hot`` rows, counted
    by a hash aggregate, take :func:`flag_first` instead.
    """
    by = list(by or keys)
    named = [F.col(k).alias(f"__by{i}") for i, k in enumerate(by)]
    many = materialize(df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot).select(*named), "hot")
    window = Window.partitionBy(*keys).orderBy(*_cols(order), *row_id)

    def ranked(rows: DataFrame) -> DataFrame:
        mine = F.struct(*row_id)
        return then(rows).withColumn(flag, F.first(mine).over(window) == mine)

    if many.isEmpty():
        return ranked(df)
    same = F.lit(True)
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"__by{i}"))
    few = F.broadcast(many)                                       # at most rows / ``hot`` keys
    return ranked(df.join(few, same, "left_anti")).unionByName(
        then(flag_first(df.join(few, same, "left_semi"), keys, order, row_id, flag)))
