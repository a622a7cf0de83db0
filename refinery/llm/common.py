"""Helpers shared by the operators: scratch tables, row identity, learning folds."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize as written
from ..session import scratch_dir as scratch

__all__ = ["ROW", "STRETCH", "give_back", "held_out", "hold", "scratch", "small", "stretches", "with_row", "written"]

ROW = "__row"
STRETCH = 1 << 20


_held: dict[str, Callable[[], None]] = {}


def hold(operator: str, release: Callable[[], None] = lambda: None) -> None:
    """Tell a Python worker, which Spark reuses, that it works for ``operator`` now:
    what it keeps for other operators is released."""
    for other in [o for o in _held if o != operator]:
        _held.pop(other)()
    _held[operator] = release
    give_back()


def give_back() -> None:
    """Return the memory that Arrow and the C library keep for later to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):        # of glibc alone
        trim(0)


def small(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches a few rows at a time (views, no copies), so that few texts are Python strings at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        give_back()


def stretches(text: str, size: int) -> Iterator[str]:
    """A long text in stretches of about ``size`` characters, cut before blanks."""
    at = 0
    while len(text) - at > size and (cut := text.find(" ", at + size)) >= 0:
        yield text[at:cut]
        at = cut
    yield text[at:]


def with_row(df: DataFrame) -> DataFrame:
    """Add ``__row``, a string that names the row: file path and row index.

    It does not depend on how a scan is split, so passes that run with other
    executors agree. A DataFrame that no Parquet scan backs is written first;
    one that has ``__row`` already is returned as it is.
    """
    if ROW in df.columns:
        return df
    def named(d: DataFrame) -> DataFrame:
        return d.select("*", F.concat_ws("#", F.col("_metadata.file_path"),
                                         F.col("_metadata.row_index")).alias(ROW))
    try:
        out = named(df)
        out.schema  # the analyser decides here whether the scan has a row index
        return out
    except AnalysisException:
        return named(written(df, "rows"))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
