"""Layout over several sort columns at once: files follow a space-filling curve.

A plain sort on (a, b) lets filters on ``a`` skip files, filters on ``b`` hardly any.
Here each column's values are ranked by its quantiles, the ranks' bits are interleaved
to one number, and the rows are range-partitioned on it, so a file covers a
narrow range of every column.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 10               # a column has at most 2^BITS ranks; the driver gets their cut points only
TEXT_BYTES = 6          # of a text's beginning; 48 bits are exact in a double


def measure(c: Column, dt: T.DataType) -> Column:
    """A double in the order of the column's values. Values that are near each other may
    share one: that changes where rows lie, never which rows there are."""
    if isinstance(dt, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dt, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, TEXT_BYTES)), 2 * TEXT_BYTES, "0")
        return F.conv(head, 16, 10).cast("double")
    raise TypeError(f"no order for a layout by {dt.simpleString()}")


def cut_points(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list[float]]:
    """At most 2^bits - 1 ascending quantiles of each column's measure, in one pass over those columns."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(*[F.percentile_approx(measure(F.col(c), df.schema[c].dataType), shares, 10 * 2**bits).alias(f"c{i}")
                   for i, c in enumerate(columns)]).first()
    return [sorted(set(row[i] or [])) for i in range(len(columns))]


def rank(value: Column, cuts: Sequence[float], bits: int = BITS) -> Column:
    """How many of the cut points are not above ``value``, by halving; NULL has rank 0."""
    points = F.array(*[F.lit(x) for x in cuts]) if cuts else F.array().cast("array<double>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    found = F.aggregate(steps, F.lit(0), lambda r, s: F.when(F.get(points, r + s - 1) <= value, r + s).otherwise(r))
    return F.coalesce(found, F.lit(0))


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """One number of the ranks' bits in turn, the highest bits first."""
    k = len(ranks)
    if k * bits > 62:
        raise ValueError(f"{k} columns of {bits} bits do not fit into 62")
    out = F.lit(0).cast("long")
    for i, r in enumerate(ranks):
        for b in range(bits):
            bit = F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, b * k + (k - 1 - i)))
    return out


def write_interleaved(df: DataFrame, path: str, columns: Sequence[str], num_files: int | None = None, bits: int = BITS) -> None:
    """``df`` as Parquet under ``path``, in the order of the curve over ``columns``.

    Rows of one place on the curve are parted further by a hash of the whole row, so a frequent
    combination of values fills as many files as it needs. Without ``num_files`` AQE sizes the files.
    """
    cuts = cut_points(df, columns, bits)
    ranked = df.withColumns({f"__r{i}": rank(measure(F.col(c), df.schema[c].dataType), p, bits)
                             for i, (c, p) in enumerate(zip(columns, cuts))})
    hashed = [c for c in df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    placed = ranked.select(*df.columns, interleaved([F.col(f"__r{i}") for i in range(len(columns))], bits).alias("__place"),
                           F.xxhash64(*hashed).alias("__hash"))
    keys = ["__place", "__hash"]
    ranged = placed.repartitionByRange(num_files, *keys) if num_files else placed.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).drop(*keys).write.mode("overwrite").parquet(path)
