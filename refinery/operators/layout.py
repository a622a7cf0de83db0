"""Physical layout for fast range lookups (the sort-key / covering-index role)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], num_files: int | None = None,
                    bucket_by: Sequence[str] = (), buckets: int = 0, table: str | None = None) -> None:
    """Range-partition and sort on ``cluster_by`` so each Parquet file and row
    group covers a narrow key range; filters on those columns then skip files
    and row groups by their min/max statistics. Optionally bucket the output
    (``saveAsTable``) so joins on ``bucket_by`` need no shuffle."""
    # Without ``num_files`` AQE coalesces adjacent ranges to the advisory size,
    # so files come out sized by volume rather than one per shuffle partition.
    ranged = df.repartitionByRange(num_files, *cluster_by) if num_files else df.repartitionByRange(*cluster_by)
    laid = ranged.sortWithinPartitions(*cluster_by)
    if bucket_by and buckets and table:
        (laid.write.mode("overwrite").format("parquet").option("path", path)
         .bucketBy(buckets, *bucket_by).sortBy(*cluster_by).saveAsTable(table))
    else:
        laid.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` as the external catalogue table ``table`` under ``path``, in hash buckets of ``keys``, one sorted file each.

    Tables whose bucket counts are equal, or multiples of each other with
    ``spark.sql.bucketing.coalesceBucketsInJoin.enabled`` (set here for the session), join on their keys without an exchange.
    A bucket is read by one task, so this is for keys of bounded frequency, such as a fact's order or line keys;
    a hot foreign key is better joined by shuffle, where AQE splits it."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true")
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)
