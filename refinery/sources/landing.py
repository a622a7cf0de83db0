"""Sinks: land to the raw zone with a manifest, quarantine, curated writes, guarded appends."""

from __future__ import annotations

import os
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from .raw import CSV_OPTIONS, MANIFEST_SCHEMA, committed_runs, escaped, read_raw


def land(df: DataFrame, root: str, source: str, table: str, batch: str) -> dict:
    """Write ``df`` as CSV (header) under a batch directory, losing nothing that
    text can hold: line breaks are escaped so that a record is a line, NULL and
    empty text differ (see ``raw.CSV_OPTIONS``). The row count comes back from
    the write itself (Observation), not from a second job. Re-running the same
    batch overwrites it, so a retried landing is idempotent."""
    key = os.path.join(source, table, f"batch={batch}")
    obs = Observation(f"land_{source}_{table}_{batch}")
    text = {f.name: escaped(F.col(f.name)) for f in df.schema if f.dataType.simpleString() == "string"}
    # a CSV writer's own form of a timestamp ends at milliseconds
    text |= {f.name: F.col(f.name).cast("string") for f in df.schema if f.dataType.simpleString().startswith("timestamp")}
    (df.withColumns(text).observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").options(**{**CSV_OPTIONS, "emptyValue": '""'}).csv(os.path.join(root, key)))
    return {"source": source, "table": table, "key": key, "row_count": int(obs.get["rows"])}


def land_all(spark: SparkSession, tables: Mapping[tuple[str, str], DataFrame], root: str, batch: str,
             changes: Mapping[tuple[str, str], DataFrame] | None = None, lsn: str = "lsn",
             checksums: bool = True, before_commit: Callable[[], None] = lambda: None) -> str:
    """Land several tables, and of the change logs ``changes`` what lies beyond their last marks, as one commit.

    Order: data, per-file checksums, and the run's manifest last. The manifest names the
    batches and holds the new marks, so readers see all of a landing or nothing of it,
    and a run that died extracts the same again. Returns the manifest path.
    """
    entries, marks = [], []
    for (src, tbl), df in tables.items():
        entries.append(land(df, root, src, tbl, batch))
    held = last_marks(spark, root, but=batch)
    for (src, tbl), log in (changes or {}).items():
        kind = log.schema[lsn].dataType
        fresh = log if held.get((src, tbl)) is None else log.filter(F.col(lsn) > F.lit(held[src, tbl]).cast(kind))
        upto = fresh.agg(F.max(lsn).cast("string").alias("m")).first()["m"]
        # up to the mark: rows that arrive while the log is read belong to the next run
        part = fresh.limit(0) if upto is None else fresh.filter(F.col(lsn) <= F.lit(upto).cast(kind))
        entries.append(land(part, root, src, tbl, batch))
        marks.append((src, tbl, upto if upto is not None else held.get((src, tbl))))
    for e in entries if checksums else ():                  # one more read of what was landed
        file_checksums(spark, root, e["key"]).write.mode("overwrite").parquet(
            os.path.join(root, "_checksums", f"run={batch}", f"{e['source']}.{e['table']}"))
    before_commit()
    return write_manifest(spark, root, batch, entries, marks)


def write_manifest(spark: SparkSession, root: str, run_ts: str, entries: Sequence[dict],
                   marks: Sequence[tuple[str, str, str | None]] = ()) -> str:
    path = os.path.join(root, "_manifests", f"run={run_ts}")
    files = [tuple(e[k] for k in ("source", "table", "key", "row_count")) for e in entries]
    doc = spark.createDataFrame([(run_ts, files, list(marks))], MANIFEST_SCHEMA)
    doc.coalesce(1).write.mode("overwrite").json(path)      # one row: the manifest is a single document
    return path


def last_marks(spark: SparkSession, root: str, but: str | None = None) -> dict[tuple[str, str], str]:
    """The newest mark of each change log in the complete manifests (of other runs than ``but``)."""
    runs = [r for r in committed_runs(spark, root) if r != but]
    if not runs:
        return {}
    marks = (spark.read.schema(MANIFEST_SCHEMA).json([os.path.join(root, "_manifests", f"run={r}") for r in runs])
             .select("run_ts", F.explode("marks").alias("m")).filter("m.mark is not null")
             .groupBy("m.source", "m.table").agg(F.max_by("m.mark", "run_ts").alias("mark")))
    return {(r["source"], r["table"]): r["mark"] for r in marks.collect()}       # a row a change log


def file_checksums(spark: SparkSession, root: str, key: str) -> DataFrame:
    """Per landed file: key, file, rows, and the sum and exclusive-or of its rows' hashes, whatever their order."""
    rows = read_raw(spark, os.path.join(root, key), landed=True)
    digest = F.xxhash64(*[F.col(c) for c in rows.columns if c != "source_file"], *[F.col(c).isNull() for c in rows.columns if c != "source_file"])
    return (rows.select(F.element_at(F.split("source_file", "/"), -1).alias("file"), digest.alias("h")).groupBy("file")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.shiftrightunsigned("h", 32)).alias("total"), F.bit_xor("h").alias("mixed"))
            .select(F.lit(key).alias("key"), "*"))


def reconcile_files(spark: SparkSession, root: str, run: str, tables: Sequence[tuple[str, str]]) -> DataFrame:
    """What a run landed against what lies there now, file by file: match / mismatch / missing / unlisted."""
    told = spark.read.parquet(*[os.path.join(root, "_checksums", f"run={run}", f"{s}.{t}") for s, t in tables])
    now = None
    for s, t in tables:
        part = file_checksums(spark, root, f"{s}/{t}/batch={run}")
        now = part if now is None else now.unionByName(part)
    a, b = told.alias("a"), now.alias("b")
    same = F.lit(True)
    for c in ("rows", "total", "mixed"):
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    status = (F.when(F.col("a.file").isNull(), F.lit("unlisted")).when(F.col("b.file").isNull(), F.lit("missing"))
              .when(same, F.lit("match")).otherwise(F.lit("mismatch")))
    return a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.file") == F.col("b.file")), "full_outer").select(
        F.coalesce("a.key", "b.key").alias("key"), F.coalesce("a.file", "b.file").alias("file"),
        F.col("a.rows").alias("landed_rows"), F.col("b.rows").alias("rows_now"), status.alias("status"))


def landed_counts(spark: SparkSession, root: str, tables: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows actually present per landed batch directory (one scan per dataset)."""
    out = None
    for src, tbl in tables:
        df = read_raw(spark, os.path.join(root, src, tbl), landed=True)
        part = (df.select(F.regexp_extract("source_file", r"(batch=\d{8}T\d{6}Z)", 1).alias("b"))
                .groupBy("b").agg(F.count(F.lit(1)).alias("landed_rows"))
                .select(F.concat_ws("/", F.lit(src), F.lit(tbl), F.col("b")).alias("key"), "landed_rows"))
        out = part if out is None else out.unionByName(part)
    return out


def reconcile_manifest(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest counts ⟗ counted rows per file; status match / mismatch / missing / unlisted."""
    j = manifest.join(landed, "key", "full_outer")
    status = (F.when(F.col("row_count").isNull(), F.lit("unlisted"))
              .when(F.col("landed_rows").isNull(), F.lit("missing"))
              .when(F.col("row_count") == F.col("landed_rows"), F.lit("match"))
              .otherwise(F.lit("mismatch")))
    return j.select("key", "source", "table", F.col("row_count").alias("manifest_rows"),
                    "landed_rows", status.alias("status"))


def append_new(df: DataFrame, target: str, keys: Sequence[str], fmt: str = "parquet") -> int:
    """Append only rows whose key is not already in ``target`` (IF NOT EXISTS … INSERT).

    Appending the same data twice leaves one copy; of several rows of one new
    key the least by its other columns is appended. Only a target that does not
    exist counts as a first load; any other read error is raised."""
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in keys]
    new = df
    if path_exists(spark, target):
        existing = spark.read.format(fmt).load(target).select(*keys).distinct()
        new = df.join(existing, list(keys), "left_anti")
    if rest:
        new = (new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
               .select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns]))
    else:
        new = new.distinct()
    obs = Observation(f"append_{abs(hash(target))}")
    new.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt).save(target)
    return int(obs.get["rows"])


def write_quarantine(rejected: DataFrame, path: str, reason_col: str = "rejection_reason",
                     fmt: str = "parquet") -> None:
    """Rejected rows with their reason and provenance. Parquet is partitioned
    by reason; ``fmt="csv"`` writes a text zone with a header (reason kept as
    a column)."""
    if fmt == "csv":
        text = {f.name: escaped(F.col(f.name)) for f in rejected.schema if f.dataType.simpleString() == "string"}
        rejected.withColumns(text).write.mode("overwrite").options(**{**CSV_OPTIONS, "emptyValue": '""'}).csv(path)
    else:
        rejected.write.mode("overwrite").partitionBy(reason_col).parquet(path)


def write_curated(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Curated Parquet overwrite. A rebalance lets AQE size the files by data volume:
    small ones are merged, and a large value of the partition columns is split."""
    w = df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Refresh only the partitions that ``df`` has rows of; the files of all others stay as they are.
    A rebalance on the partition columns splits a hot partition over files and merges small ones."""
    (df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
