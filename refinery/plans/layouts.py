"""Physical layout and catalogue: several sort columns, bucketed tables, widening types, time by log ranges."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators import cdc
from ..operators.interleave import write_interleaved
from ..operators.layout import write_bucketed
from ..session import scratch_dir
from ..sources.catalog import register_table
from .cdc import LOG_SQL, change_log
from .common import t
from .registry import attach, query


@query("interleaved_lookup")
def interleaved_lookup(spark, sf):
    """Two range look-ups, by ship date and by part, of one copy of the lines that is laid out for both."""
    path = scratch_dir(spark, "interleaved")
    write_interleaved(t(spark, sf, "lineitem"), path, ["l_shipdate", "l_partkey"])
    li = spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    by_date = li.filter((F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
                        & (F.col("l_shipdate") < F.lit("1995-04-01").cast("timestamp_ntz")))
    by_part = li.filter(F.col("l_partkey").between(20, 40))
    return (by_date.withColumn("found_by", F.lit("date"))
            .unionByName(by_part.withColumn("found_by", F.lit("part"))))


def bucketed(spark, sf, fact_buckets: int = 32, dim_buckets: int = 16):
    """(lines by order, orders) as bucketed catalogue tables."""
    root = scratch_dir(spark, "bucketed")
    name = os.path.basename(root).replace("-", "_")
    lines = write_bucketed(t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"),
                           f"{name}_lines", f"{root}/lines", ["l_orderkey"], fact_buckets)
    orders = write_bucketed(t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"),
                            f"{name}_orders", f"{root}/orders", ["o_orderkey"], dim_buckets)
    return lines, orders


@query("bucketed_star_join")
def bucketed_star_join(spark, sf):
    """Lines with their orders' status, both sides stored in buckets of the key: neither is shuffled."""
    lines, orders = bucketed(spark, sf)
    return (lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select("l_orderkey", "l_linenumber", "o_custkey", "o_orderstatus"))


@query("catalog_widened")
def catalog_widened(spark, sf):
    """Three batches of orders whose columns grow wider, read through SQL as one catalogue table, joined to customers."""
    root = scratch_dir(spark, "zone")
    name = os.path.basename(root).replace("-", "_")
    o = t(spark, sf, "orders")
    for i, (status, whole, money) in enumerate((("F", "smallint", "decimal(12,2)"), ("O", "int", "decimal(14,2)"),
                                                ("P", "bigint", "decimal(15,2)"))):
        (o.filter(F.col("o_orderstatus") == status)
         .select("o_orderkey", "o_custkey", F.year("o_orderdate").cast(whole).alias("order_year"),
                 F.col("o_totalprice").cast(money).alias("price"))
         .write.parquet(f"{root}/orders/batch=2024010{i + 1}T000000Z"))
    register_table(spark, f"{name}_orders", f"{root}/orders")
    t(spark, sf, "customer").select("c_custkey", "c_mktsegment").write.parquet(f"{root}/customer/batch=20240101T000000Z")
    register_table(spark, f"{name}_customer", f"{root}/customer")
    return spark.sql(f"""
SELECT o.batch, c.c_mktsegment, o.order_year, COUNT(*) AS n_orders, CAST(SUM(o.price) AS DECIMAL(25,2)) AS total
FROM {name}_orders o JOIN {name}_customer c ON o.o_custkey = c.c_custkey GROUP BY o.batch, c.c_mktsegment, o.order_year""")


@query("cdc_time_ranges")
def cdc_time_ranges(spark, sf):
    """Every change with the commit time of the log range it lies in; the map has the ranges' starts only."""
    log = change_log(spark, sf)
    marks = log.groupBy(F.date_trunc("hour", "lsn").alias("h")).agg(F.min("lsn").alias("start_lsn"), F.max("lsn").alias("commit_time"))
    late = marks.filter(F.hour("h") % 3 == 1).select("start_lsn", "commit_time")
    return cdc.map_range_time(log, late).select("seq", "lsn", "operation", "user_id", "commit_time")


attach({
    "interleaved_lookup": """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, 'date' AS found_by FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1995-04-01'
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, 'part' FROM lineitem WHERE l_partkey BETWEEN 20 AND 40""",
    "bucketed_star_join": """
SELECT l_orderkey, l_linenumber, o_custkey, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "catalog_widened": """
SELECT CASE o_orderstatus WHEN 'F' THEN '20240101T000000Z' WHEN 'O' THEN '20240102T000000Z' ELSE '20240103T000000Z' END AS batch,
       c_mktsegment, CAST(year(o_orderdate) AS BIGINT) AS order_year, COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS total
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY 1, 2, 3""",
    "cdc_time_ranges": f"""WITH {LOG_SQL},
marks AS (SELECT date_trunc('hour', lsn) AS h, MIN(lsn) AS start_lsn, MAX(lsn) AS commit_time FROM log GROUP BY 1),
late AS (SELECT * FROM marks WHERE hour(h) % 3 = 1)
SELECT l.seq, l.lsn, l.operation, l.user_id, m.commit_time FROM log l ASOF LEFT JOIN late m ON l.lsn >= m.start_lsn""",
})
