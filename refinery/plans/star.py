"""Star schema on the analytic tables: nation / part / customer dimensions and a sales fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality, star
from ..operators.measures import measures
from ..operators.rules import flag_exists
from . import dq
from .common import t
from .registry import attach, query


def dim_nation_df(spark, sf):
    n = t(spark, sf, "nation").join(t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return star.build_dimension(n, ["n_nationkey"], ["n_name", "r_name"], "nation_key")


def dim_part_df(spark, sf):
    return star.build_dimension(t(spark, sf, "part"), ["p_partkey"], ["p_brand", "p_type", "p_size"], "part_key")


def dim_customer_df(spark, sf):
    return star.build_dimension(t(spark, sf, "customer"), ["c_custkey"],
                                ["c_nationkey", "c_mktsegment"], "customer_key")


def fact_base(spark, sf):
    """Fact rows at the line grain with natural keys and measures."""
    li = t(spark, sf, "lineitem")
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"]).drop("o_orderkey")
            .withColumn("line_count", F.lit(1))
            .withColumn("is_open", F.col("l_linestatus") == "O")
            .withColumn("amount", F.col("l_extendedprice").cast("decimal(18,2)")))


def fact_sales_df(spark, sf, dims=None):
    """Fact rows with surrogate keys; ``dims`` = (part, customer, nation) when already built."""
    d_part, d_cust, d_nation = dims or (dim_part_df(spark, sf), dim_customer_df(spark, sf), dim_nation_df(spark, sf))
    base = fact_base(spark, sf)
    fact = star.lookup_keys(base, [
        (d_part, [("l_partkey", "p_partkey")], ["part_key"]),
        (d_cust, [("o_custkey", "c_custkey")], ["customer_key", "c_nationkey"]),
        (d_nation, [("c_nationkey", "n_nationkey")], ["nation_key"]),
    ])
    return fact.select("l_orderkey", "l_linenumber", "part_key", "customer_key", "nation_key",
                       "l_quantity", "amount", "line_count", "is_open")


@query("dim_nation")
def dim_nation(spark, sf):
    return dim_nation_df(spark, sf)


@query("dim_part")
def dim_part(spark, sf):
    return dim_part_df(spark, sf)


@query("dim_customer")
def dim_customer(spark, sf):
    return dim_customer_df(spark, sf)


@query("fact_sales")
def fact_sales(spark, sf):
    return fact_sales_df(spark, sf)


@query("fact_unmatched")
def fact_unmatched(spark, sf):
    li = t(spark, sf, "lineitem")
    parts = t(spark, sf, "part").filter(F.col("p_size") >= 3)
    supp = t(spark, sf, "supplier").filter(F.col("s_acctbal") >= 0)
    # one pass over the lines with a flag a dimension
    flagged = flag_exists(flag_exists(li.select("l_partkey", "l_suppkey"), parts, [("l_partkey", "p_partkey")], "_part"),
                          supp, [("l_suppkey", "s_suppkey")], "_supplier")
    counts = flagged.agg(F.count_if(F.col("l_partkey").isNotNull() & ~F.col("_part")).alias("p"),
                         F.count_if(F.col("l_suppkey").isNotNull() & ~F.col("_supplier")).alias("s"))
    return counts.select(F.stack(F.lit(2), F.lit("dim_part"), "p", F.lit("dim_supplier"), "s").alias("dimension", "unmatched_rows"))


@query("kpi_by_brand")
def kpi_by_brand(spark, sf):
    d_part = dim_part_df(spark, sf)
    f = (fact_sales_df(spark, sf, (d_part, dim_customer_df(spark, sf), dim_nation_df(spark, sf)))
         .join(d_part.select("part_key", "p_brand"), "part_key"))
    return measures(f, ["p_brand"], "line_count", "is_open", "amount", 2)


@query("stable_keys")
def stable_keys(spark, sf):
    """Surrogate keys carried across two loads: customers of the first load keep
    their keys, customers first seen in the second load get the next ones."""
    cust = t(spark, sf, "customer")
    first = star.extend_key_map(cust.filter(F.col("c_mktsegment") < "HOUSEHOLD"), ["c_custkey"], "customer_key")
    return star.extend_key_map(cust, ["c_custkey"], "customer_key", first)


@query("stage_counts")
def stage_counts(spark, sf):
    # accepted and rejected come from one pass over the classification
    dq_counts = (quality.summary(dq.classified(spark, sf))
                 .selectExpr("stack(2, 'dq_accepted', accepted, 'dq_rejected', rejected) AS (table_name, row_count)"))
    dims = (dim_part_df(spark, sf), dim_customer_df(spark, sf), dim_nation_df(spark, sf))
    return quality.stage_counts({
        "raw_lineitem": t(spark, sf, "lineitem"),
        "dim_nation": dims[2],
        "dim_part": dims[0],
        "dim_customer": dims[1],
        "fact_sales": fact_sales_df(spark, sf, dims),
    }).unionByName(dq_counts)


_DIMS = """
dim_nation AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY n_nationkey, n_name, r_name) AS BIGINT) AS nation_key,
         n_nationkey, n_name, r_name
  FROM (SELECT DISTINCT n.n_nationkey, n.n_name, r.r_name FROM nation n
        LEFT JOIN region r ON r.r_regionkey = n.n_regionkey)),
dim_part AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY p_partkey, p_brand, p_type, p_size) AS BIGINT) AS part_key,
         p_partkey, p_brand, p_type, p_size
  FROM (SELECT DISTINCT p_partkey, p_brand, p_type, p_size FROM part)),
dim_customer AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY c_custkey, c_nationkey, c_mktsegment) AS BIGINT) AS customer_key,
         c_custkey, c_nationkey, c_mktsegment
  FROM (SELECT DISTINCT c_custkey, c_nationkey, c_mktsegment FROM customer)),
fact_sales AS (
  SELECT l.l_orderkey, l.l_linenumber, p.part_key, c.customer_key, n.nation_key, l.l_quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, 1 AS line_count, l.l_linestatus = 'O' AS is_open
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN dim_part p ON p.p_partkey = l.l_partkey
  JOIN dim_customer c ON c.c_custkey = o.o_custkey
  JOIN dim_nation n ON n.n_nationkey = c.c_nationkey)
"""

attach({
    "dim_nation": "WITH " + _DIMS + "SELECT * FROM dim_nation",
    "dim_part": "WITH " + _DIMS + "SELECT * FROM dim_part",
    "dim_customer": "WITH " + _DIMS + "SELECT * FROM dim_customer",
    "fact_sales": "WITH " + _DIMS + "SELECT * FROM fact_sales",
    "fact_unmatched": """
SELECT 'dim_part' AS dimension, COUNT(*) AS unmatched_rows FROM lineitem l
WHERE l.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size >= 3)
UNION ALL
SELECT 'dim_supplier', COUNT(*) FROM lineitem l
WHERE l.l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey AND s.s_acctbal >= 0)""",
    "stable_keys": """
WITH first AS (
  SELECT c_custkey, CAST(ROW_NUMBER() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_key
  FROM (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment < 'HOUSEHOLD')),
fresh AS (
  SELECT c_custkey FROM (SELECT DISTINCT c_custkey FROM customer) c
  WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.c_custkey = c.c_custkey))
SELECT c_custkey, customer_key FROM first
UNION ALL
SELECT c_custkey, (SELECT COUNT(*) FROM first) + CAST(ROW_NUMBER() OVER (ORDER BY c_custkey) AS BIGINT) FROM fresh""",
    "kpi_by_brand": "WITH " + _DIMS + """
SELECT p.p_brand, CAST(SUM(f.line_count) AS BIGINT) AS total, COUNT(*) FILTER (WHERE f.is_open) AS active,
       ROUND(CAST(SUM(f.amount) AS DOUBLE) / COUNT(f.amount), 2) AS avg_value
FROM fact_sales f JOIN dim_part p ON p.part_key = f.part_key GROUP BY p.p_brand""",
    "stage_counts": dq.DQ_CTE.rstrip().rstrip(")") + "),\n" + _DIMS.strip() + """
SELECT 'raw_lineitem' AS table_name, COUNT(*) AS row_count FROM lineitem
UNION ALL SELECT 'dq_accepted', COUNT(*) FROM classified WHERE rejection_reason IS NULL
UNION ALL SELECT 'dq_rejected', COUNT(*) FROM classified WHERE rejection_reason IS NOT NULL
UNION ALL SELECT 'dim_nation', COUNT(*) FROM dim_nation
UNION ALL SELECT 'dim_part', COUNT(*) FROM dim_part
UNION ALL SELECT 'dim_customer', COUNT(*) FROM dim_customer
UNION ALL SELECT 'fact_sales', COUNT(*) FROM fact_sales""",
})
