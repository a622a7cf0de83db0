"""Read the analytic tables (one parquet dataset per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators.rules import with_row_id

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, row_id: bool = False) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return with_row_id(df) if row_id else df


def register_all(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views for SQL users (no data is read until a query runs)."""
    for n in names:
        p = table_path(sf_dir, n)
        if os.path.exists(p):
            spark.read.parquet(p).createOrReplaceTempView(n)
