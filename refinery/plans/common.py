"""Shared helpers for the query catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import load


def t(spark: SparkSession, sf_dir: str, name: str, row_id: bool = False) -> DataFrame:
    return load(spark, sf_dir, name, row_id=row_id)
