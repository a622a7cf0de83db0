"""Raw (text) zone: batch-stamped CSV datasets ``<root>/<source>/<table>/batch=<id>/``."""

from __future__ import annotations

import os
import re
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import child_dirs, path_exists

BATCH_RE = re.compile(r"batch=(\d{8}T\d{6}Z)")


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


# How landed text is written: a line break would split a record, so it is escaped, and the
# escape sign with it; NULL has a form of its own. Files stay one record a line and splittable.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
ESCAPES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def escaped(c: Column) -> Column:
    """Text without line breaks, for one record a line; :func:`unescaped` gives it back."""
    for plain, coded in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescaped(c: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def read_raw(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
             provenance: bool = True, landed: bool = False) -> DataFrame:
    """Every column as text. With ``columns`` the header must name exactly
    those columns (``enforceSchema=false``): a reordered or renamed header
    fails instead of being silently mis-mapped by position. ``landed`` reads
    what :func:`refinery.sources.landing.land` wrote: line breaks come back,
    and NULL and empty text are told apart."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if landed:
        reader = reader.options(**CSV_OPTIONS)
    if columns is not None:
        reader = reader.schema(text_schema(columns)).option("enforceSchema", False)
    df = reader.csv(path)
    if landed:
        df = df.select("*", F.col("_metadata.file_path").alias("source_file")) if provenance else df
        return df.withColumns({c: unescaped(F.col(c)) for c in df.columns if c != "source_file"})
    if provenance:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def batches(spark: SparkSession, path: str) -> list[str]:
    """Batch ids present under ``path``: one listing of the dataset folder, no files."""
    return sorted(m.group(1) for d in child_dirs(spark, path) for m in [BATCH_RE.fullmatch(d)] if m)


def read_latest(spark: SparkSession, path: str, columns: Sequence[str] | None = None, landed: bool = True) -> DataFrame:
    """Only the newest batch of a dataset that is landed as a whole, chosen by batch id from the listing.

    A batch counts once its run's manifest, which is written last, is complete; so a
    landing that is under way, or died between two tables, is not seen.

    The reference picks the maximum file name among rows that exist, so a
    header-only newest batch silently falls back to an older one; here the
    newest batch is read even when it is empty. Only that batch directory is
    scanned. ``landed=False`` reads files of another writer as they are.
    """
    ids = batches(spark, path)
    if landed:
        ids = _committed(spark, path, ids)
    if not ids:
        raise FileNotFoundError(f"no batch under {path}")
    latest = ids[-1]
    df = read_raw(spark, os.path.join(path, f"batch={latest}"), columns, landed=landed)
    return df.withColumn("batch", F.lit(latest))


def read_source(spark: SparkSession, fmt: str, table: str | None = None, path: str | None = None,
                options: dict | None = None) -> DataFrame:
    """Full-table extract from any Spark source. For ``jdbc`` pass ``url``,
    and for a parallel read ``partitionColumn``/``lowerBound``/``upperBound``/
    ``numPartitions`` in ``options``; files use ``path``."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "jdbc":
        return reader.option("dbtable", table).load()
    return reader.load(path)


def register_zone(spark: SparkSession, root: str, fmt: str = "parquet") -> list[str]:
    """Register each dataset directory under ``root`` as a temp view named after it
    (a catalog crawl with the schema of the file footers; one listing of ``root``)."""
    names = child_dirs(spark, root)
    for name in names:
        spark.read.format(fmt).option("mergeSchema", True).load(f"{root.rstrip('/')}/{name}").createOrReplaceTempView(name)
    return names


MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_ts", T.StringType()),
    T.StructField("files", T.ArrayType(T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("row_count", T.LongType()),
    ]))),
    T.StructField("marks", T.ArrayType(T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("mark", T.StringType()),
    ]))),
])


def committed_runs(spark: SparkSession, root: str) -> list[str]:
    """Run ids of the landings under ``root`` whose manifest is complete, oldest first."""
    runs = (d.split("=", 1)[1] for d in child_dirs(spark, f"{root}/_manifests") if d.startswith("run="))
    return sorted(r for r in runs if path_exists(spark, f"{root}/_manifests/run={r}/_SUCCESS"))


def _committed(spark: SparkSession, path: str, ids: Sequence[str]) -> list[str]:
    """Of the batches of a dataset ``<root>/<source>/<table>``, those that are landed as a whole: named by a complete
    manifest where the zone has manifests, else without the folder that a Spark write under way leaves in them."""
    root, source, table = path.rstrip("/").rsplit("/", 2)
    if not path_exists(spark, f"{root}/_manifests"):
        return [b for b in ids if not path_exists(spark, f"{path}/batch={b}/_temporary")]
    done = committed_runs(spark, root)
    if not done:
        return []
    keys = {r["key"] for r in read_manifest(spark, [f"{root}/_manifests/run={r}" for r in done])
            .filter((F.col("source") == source) & (F.col("table") == table)).select("key").distinct().collect()}  # a row a batch
    return [b for b in ids if f"{source}/{table}/batch={b}" in keys]


def read_manifest(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Manifest JSON → one row per landed file (run_ts, source, table, key, row_count)."""
    m = spark.read.schema(MANIFEST_SCHEMA).json(path)
    return m.select("run_ts", F.explode("files").alias("f")).select("run_ts", "f.*")


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Per run: landed files and the rows they hold."""
    return manifest.groupBy("run_ts").agg(F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("total_rows"))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Bulk typed CSV load with a header (COPY … CSV): a value that does not
    fit its declared type fails the load instead of becoming NULL."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).csv(path))


def read_positional(spark: SparkSession, path: str, names: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Load columns by position and rename them (COPY … FORMAT PARQUET into a
    table whose column names differ, e.g. ``count`` → ``rejected_count``)."""
    return spark.read.format(fmt).load(path).toDF(*names)
