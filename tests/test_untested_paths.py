"""Smaller entry points: generic source read, table views, bucketed layout, cluster settings."""

import datetime as dt

from pyspark.sql import functions as F

from refinery.operators import cdc
from refinery.operators.layout import write_clustered
from refinery.session import CLUSTER_CONF, apply_cluster_conf, scratch_dir
from refinery.sources import landing, raw, tables

from .conftest import SF_SMALL


def test_read_source_any_format(spark):
    df = raw.read_source(spark, "parquet", path=f"{SF_SMALL}/nation.parquet")
    assert df.count() == 25


def test_register_all_views(spark):
    tables.register_all(spark, SF_SMALL, ["nation", "region"])
    assert spark.sql("SELECT COUNT(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey").collect()[0].n == 25


def test_bucketed_clustered_table(spark):
    path = scratch_dir(spark, "bucketed")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    write_clustered(li, path, ["l_shipdate"], bucket_by=["l_orderkey"], buckets=4, table="li_bucketed")
    t = spark.table("li_bucketed")
    assert t.count() == li.count()
    plan = t.groupBy("l_orderkey").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan          # bucketed on the key: no shuffle for the aggregate
    spark.sql("DROP TABLE li_bucketed")


def test_apply_cluster_conf_is_runtime_settable(spark):
    before = {k: spark.conf.get(k) for k in CLUSTER_CONF}
    try:
        apply_cluster_conf(spark, {"spark.sql.shuffle.partitions": "8"})
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_incremental_by_timestamp(spark):
    df = spark.createDataFrame([(1, dt.datetime(2026, 1, 1)), (2, dt.datetime(2026, 1, 3))],
                               "id int, updated_at timestamp_ntz")
    assert [r.id for r in cdc.incremental_by_timestamp(df, "updated_at", "2026-01-02 00:00:00").collect()] == [2]


def test_quarantine_formats(spark):
    rej = spark.createDataFrame([(1, "A"), (2, "B")], "id int, rejection_reason string")
    pq_path, csv_path = scratch_dir(spark, "q_pq"), scratch_dir(spark, "q_csv")
    landing.write_quarantine(rej, pq_path)
    landing.write_quarantine(rej, csv_path, fmt="csv")
    assert spark.read.parquet(pq_path).filter(F.col("rejection_reason") == "A").count() == 1
    assert spark.read.option("header", True).csv(csv_path).count() == 2
