"""Small column-expression helpers (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketize(c: Column | str, bounds: list, labels: list[str]) -> Column:
    """CASE range buckets: ``labels[i]`` for ``c < bounds[i]``, last label otherwise."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need len(bounds) + 1 labels")
    col = _c(c)
    out = F.when(col < F.lit(bounds[0]), F.lit(labels[0]))
    for b, lab in zip(bounds[1:], labels[1:-1]):
        out = out.when(col < F.lit(b), F.lit(lab))
    return out.otherwise(F.lit(labels[-1]))


def decode(c: Column | str, mapping: dict, default=None) -> Column:
    """Map codes to labels (CASE WHEN code = k THEN v ...)."""
    col = _c(c)
    items = list(mapping.items())
    out = F.when(col == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        out = out.when(col == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def end_of_month(c: Column | str, months: int = 0) -> Column:
    """Last day of the month ``months`` after ``c`` (EOMONTH)."""
    return F.last_day(F.add_months(_c(c).cast("date"), months))


def pass_rate(accepted: Column | str, total: Column | str, scale: int = 4) -> Column:
    """round(accepted / total, scale); NULL on empty input instead of an error."""
    return F.round(F.try_divide(_c(accepted).cast("double"), _c(total).cast("double")), scale)


def batch_id(ts: Column | str) -> Column:
    """Batch identifier ``yyyyMMdd'T'HHmmss'Z'`` from a UTC timestamp."""
    return F.date_format(_c(ts), "yyyyMMdd'T'HHmmss'Z'")


def money_text(c: Column | str) -> Column:
    """Decimal money rendered with two decimals."""
    return _c(c).cast("decimal(18,2)").cast("string")


def hex_text(c: Column | str, prefix: str = "0x") -> Column:
    """Binary (e.g. a log sequence number) as fixed-width hex text; the text
    sorts in the same order as the bytes."""
    return F.concat(F.lit(prefix), F.hex(_c(c)))
