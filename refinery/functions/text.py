"""Raw text → typed columns (standardize) as one projection of Catalyst expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blank_to_null(c: Column | str) -> Column:
    """Trim ASCII spaces; an empty result becomes NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(col), F.lit(""))


@dataclass(frozen=True)
class Field:
    """Target column spec.

    ``source`` is the raw column (defaults to ``name``); ``dtype`` a Spark SQL
    type name (``string``, ``bigint``, ``int``, ``decimal(10,2)``, ``date`` ...);
    ``upper`` upper-cases text; ``default`` is a SQL expression used when the
    typed value is NULL (column DEFAULT); ``date_format`` an optional pattern.
    """

    name: str
    dtype: str = "string"
    source: str | None = None
    upper: bool = False
    default: str | None = None
    date_format: str | None = None
    extra: dict = field(default_factory=dict)

    def expr(self) -> Column:
        text = blank_to_null(self.source or self.name)
        if self.upper:
            text = F.upper(text)
        t = self.dtype.lower()
        if t == "string":
            typed = text
        elif t == "date":
            typed = F.try_to_date(text, self.date_format) if self.date_format else F.try_to_date(text)
        elif t in ("timestamp", "timestamp_ntz"):
            typed = (F.try_to_timestamp(text, F.lit(self.date_format)) if self.date_format
                     else F.try_to_timestamp(text))
            if t == "timestamp_ntz":
                typed = typed.cast("timestamp_ntz")
        elif t == "boolean":
            typed = text.try_cast("boolean")
        else:
            typed = text.try_cast(t)
        if self.default is not None:
            typed = F.coalesce(typed, F.expr(self.default).cast(t))
        return typed.alias(self.name)


def standardize(df: DataFrame, fields: list[Field], keep: list[str] = (),
                literals: dict | None = None, keep_raw: bool = False) -> DataFrame:
    """Project ``df`` to ``fields`` (typed, malformed text → NULL) in one select.

    ``keep`` lists columns passed through unchanged (provenance), ``literals``
    adds constant columns (e.g. ``source_system``), ``keep_raw`` keeps the
    original text of every field in a ``raw`` struct so rejected rows do not
    lose the offending value.
    """
    cols = [f.expr() for f in fields]
    cols += [F.col(k) for k in keep]
    cols += [F.lit(v).alias(k) for k, v in (literals or {}).items()]
    if keep_raw:
        srcs = sorted({f.source or f.name for f in fields})
        cols.append(F.struct(*[F.col(s).cast("string").alias(s) for s in srcs]).alias("raw"))
    return df.select(*cols)


def unparseable(fields: list[Field], raw_col: str = "raw") -> Column:
    """True when some field had non-blank raw text but standardized to NULL
    (malformed value silently dropped by the cast). Needs ``keep_raw=True``;
    use it as an optional ``UNPARSEABLE_VALUE`` rule."""
    out = F.lit(False)
    for f in fields:
        src = f.source or f.name
        out = out | (blank_to_null(F.col(f"{raw_col}.{src}")).isNotNull() & F.col(f.name).isNull())
    return out
