"""Reporting helpers: measure sets, top-N, what-if edits, prioritized unions."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import flag_first


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """ORDER BY … LIMIT n; callers pass a total order (tiebreak key last).
    Spark plans this as TakeOrderedAndProject: each task keeps n rows."""
    return df.orderBy(*order).limit(n)


def what_if(df: DataFrame, where: Column, changes: Mapping[str, Column]) -> DataFrame:
    """The rows of ``df`` matching ``where`` with ``changes`` applied; ``df`` itself
    is untouched (the immutable form of UPDATE … then ROLLBACK)."""
    out = df.filter(where)
    for name, expr in changes.items():
        out = out.withColumn(name, expr)
    return out


def measures(df: DataFrame, by: Sequence[str], count_col: str, flag_col: str, value_col: str,
             scale: int = 2) -> DataFrame:
    """KPI set per group: total (sum of the count column), active (count of flag),
    average value as round(sum/count, scale) over an exact decimal sum."""
    return (df.groupBy(*by)
            .agg(F.sum(F.col(count_col)).cast("bigint").alias("total"),
                 F.count_if(F.col(flag_col)).alias("active"),
                 F.round(F.sum(F.col(value_col).cast("decimal(18,2)")).cast("double")
                         / F.count(F.col(value_col)), scale).alias("avg_value")))


def prioritized_union(sources: Mapping[str, DataFrame], key: Sequence[str], priority: Sequence[str],
                      row_id: Sequence[str], source_col: str = "source_system") -> DataFrame:
    """UNION ALL by column name, then keep one row per key from the best-ranked source.

    ``priority`` is explicit (first wins) rather than alphabetical; ``row_id``
    columns must identify a row within its source.
    """
    rank = {s: i for i, s in enumerate(priority)}
    tagged = None
    for name, df in sources.items():
        part = df.withColumn(source_col, F.lit(name)).withColumn("_src_rank", F.lit(rank[name]))
        tagged = part if tagged is None else tagged.unionByName(part)
    return (flag_first(tagged, key, ["_src_rank"], ["_src_rank", *row_id], flag="_keep")
            .filter("_keep").drop("_keep", "_src_rank"))
