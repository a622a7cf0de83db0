"""Datasets in batch folders as catalogue tables whose column types widen from batch to batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import child_dirs

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


class SchemaConflict(ValueError):
    """Columns whose types in different batches have no common wider type."""


@dataclass(frozen=True)
class Found:
    """A column's type in one batch folder."""
    column: str
    type: T.DataType
    folder: str


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds every value of both without loss, as Parquet files of either can be read; None: there is none.

    Whole numbers widen to longer ones, float to double, whole numbers of up to 32 bits to double, decimals to
    one of more digits before and as many after the point, a date to a timestamp without zone."""
    if a == b:
        return a
    pair = {type(a), type(b)}
    if pair <= set(_WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if pair == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if T.DoubleType in pair and pair & {T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    if pair == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if pair == {T.DecimalType}:
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if T.DecimalType in pair and pair & set(_WHOLE):
        d, n = (a, b) if isinstance(a, T.DecimalType) else (b, a)
        whole = max(d.precision - d.scale, _DIGITS[type(n)])
        return T.DecimalType(whole + d.scale, d.scale) if whole + d.scale <= 38 else None
    return None


def found_columns(spark: SparkSession, path: str, partition: str) -> list[Found]:
    """Every column of every folder ``<path>/<partition>=…``, from the footers; a batch is written by
    one job, so one footer of it is read."""
    folders = [d for d in child_dirs(spark, path) if d.startswith(f"{partition}=")]
    return [Found(f.name, f.dataType, d) for d in folders for f in spark.read.parquet(f"{path}/{d}").schema]


def widened_schema(found: list[Found]) -> T.StructType:
    """One schema for all batches, columns in the order they were first met. A column whose types have no common
    one raises :class:`SchemaConflict`, which names them all."""
    types: dict[str, T.DataType] = {}
    clashes: dict[str, None] = {}
    for f in found:
        if (both := wider(types.setdefault(f.column, f.type), f.type)) is None:
            clashes[f.column] = None
        else:
            types[f.column] = both
    if clashes:
        raise SchemaConflict("; ".join(
            f"{c}: " + ", ".join(f"{f.type.simpleString()} in {f.folder}" for f in found if f.column == c) for c in clashes))
    return T.StructType([T.StructField(c, dt) for c, dt in types.items()])


def register_table(spark: SparkSession, name: str, path: str, partition: str = "batch") -> DataFrame:
    """External catalogue table ``name`` over the batch folders under ``path``, with a schema wide enough for all of
    them and its partitions recovered; SQL sees it as one table. Files stay as they are, and
    registering again takes in new batches. A table that is there under that name is replaced, its files are not."""
    found = found_columns(spark, path, partition)
    if not found:
        raise FileNotFoundError(f"no folder {partition}=… under {path}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in widened_schema(found))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}, `{partition}` STRING) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)
