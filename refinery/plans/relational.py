"""Analysis queries, standardization, constraint checks (role-mapped onto the TPC-H-like tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expr import bucketize, end_of_month
from ..functions.text import Field, standardize, unparseable
from ..operators.rules import Rule, classify
from ..operators import quality
from ..operators.measures import prioritized_union, top_n, what_if
from ..operators.rules import with_row_id
from .common import t
from .registry import attach, query

# Bounds and labels of the order value classes.
TIER_BOUNDS = [100000, 300000]
TIER_LABELS = ["small", "medium", "large"]


@query("q1_top_orders")
def q1_top_orders(spark, sf):
    o = t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    c = t(spark, sf, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner").select(
        "o_orderkey", "o_custkey", "c_name", "c_nationkey", "o_totalprice")
    return top_n(j, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("q2_no_activity")
def q2_no_activity(spark, sf):
    c = t(spark, sf, "customer")
    e = t(spark, sf, "events").select(F.col("user_id")).distinct()    # pre-aggregate: hot users collapse map-side
    idle = c.join(e, c["c_custkey"] == e["user_id"], "left_anti")
    return idle.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers_without_events"))


@query("q3_having")
def q3_having(spark, sf):
    o = t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = t(spark, sf, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    g = j.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("f_orders"),
        F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)), 4)
        .alias("avg_totalprice"))
    return g.filter(F.col("f_orders") >= 200).orderBy(F.col("avg_totalprice").desc(), "n_name")


@query("q4_tiers")
def q4_tiers(spark, sf):
    o = t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    tier = bucketize("o_totalprice", TIER_BOUNDS, TIER_LABELS).alias("price_tier")
    return o.groupBy(tier).agg(F.count(F.lit(1)).alias("orders")).orderBy("price_tier")


@query("q5_histogram")
def q5_histogram(spark, sf):
    per_cust = t(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("order_count"))
    return (per_cust.groupBy("order_count").agg(F.count(F.lit(1)).alias("customers"))
            .orderBy("order_count"))


@query("q6_what_if")
def q6_what_if(spark, sf):
    o = t(spark, sf, "orders")
    target = o.filter(F.col("o_orderstatus") == "F").agg(F.min("o_orderkey")).scalar()
    base = o.filter(F.col("o_orderkey") == target).select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"),
        F.lit(None).cast("date").alias("end_date"))
    changed = what_if(base, F.lit(True), {"o_orderstatus": F.lit("X"),
                                          "end_date": end_of_month("o_orderdate", 2)})
    return (base.withColumn("stage", F.lit("before"))
            .unionByName(changed.withColumn("stage", F.lit("what_if"))))


@query("point_lookup")
def point_lookup(spark, sf):
    o = t(spark, sf, "orders")
    key = (o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
           .agg(F.min("o_orderkey")).scalar())
    li = t(spark, sf, "lineitem")
    return li.filter((F.col("l_orderkey") == key) & (F.col("l_linestatus") == "F"))


@query("join_order_preview")
def join_order_preview(spark, sf):
    s = t(spark, sf, "supplier")
    n = t(spark, sf, "nation")
    return (s.join(n, s["s_nationkey"] == n["n_nationkey"])
            .select("s_suppkey", "s_name", "n_name", "s_acctbal").orderBy("n_name", "s_suppkey"))


def orders_as_text(spark, sf):
    """Render orders to raw text with padding, blanks, foreign formats and junk."""
    o = t(spark, sf, "orders")
    return o.select(
        F.concat(F.lit("  "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("orderkey_txt"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_custkey").cast("string"))
        .alias("custkey_txt"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("price_txt"),
        F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_txt"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("priority_txt"))


ORDER_SPEC = [
    Field("o_orderkey", "bigint", source="orderkey_txt"),
    Field("o_custkey", "bigint", source="custkey_txt"),
    Field("o_totalprice", "decimal(12,2)", source="price_txt"),
    Field("o_orderdate", "date", source="date_txt"),
    Field("o_orderpriority", "string", source="priority_txt", upper=True),
]


@query("standardize_text")
def standardize_text(spark, sf):
    return standardize(orders_as_text(spark, sf), ORDER_SPEC)


@query("standardize_unparseable")
def standardize_unparseable(spark, sf):
    """Rows whose non-blank raw text failed to parse, flagged by the optional rule."""
    std = standardize(orders_as_text(spark, sf), ORDER_SPEC, keep_raw=True)
    cls = classify(std, [Rule("UNPARSEABLE_VALUE", unparseable(ORDER_SPEC))])
    return (cls.groupBy(F.coalesce(F.col("rejection_reason"), F.lit("ACCEPTED")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def constraint_checks(spark, sf):
    orders, li, cust, part = (t(spark, sf, n) for n in ("orders", "lineitem", "customer", "part"))
    good_cust = cust.filter(F.col("c_acctbal") >= 0)
    reports = {
        "orders": quality.validate(orders, [
            quality.primary_key("orders_pk", "o_orderkey"),
            quality.foreign_key("orders_customer_fk", ["o_custkey"], good_cust, ["c_custkey"]),
            quality.check("orders_status_in", F.col("o_orderstatus").isin("F", "O", "P")),
            quality.not_null("orders_date_not_null", "o_orderdate"),
        ]),
        "lineitem": quality.validate(li, [
            quality.primary_key("lineitem_pk", "l_orderkey", "l_linenumber"),
            quality.foreign_key("lineitem_orders_fk", ["l_orderkey"], orders, ["o_orderkey"]),
            quality.check("lineitem_discount_le_tax", "l_discount <= l_tax"),
            quality.check("lineitem_quantity_between", F.col("l_quantity").between(1, 49)),
        ]),
        "customer": quality.validate(cust, [
            quality.unique("customer_name_segment_unique", "c_name", "c_mktsegment"),
            quality.check("customer_balance_ge_0", F.col("c_acctbal") >= 0),
            quality.max_length("customer_name_len", "c_name", 17),
        ]),
        "part": quality.validate(part, [
            quality.check("part_size_between", F.col("p_size").between(1, 50)),
            quality.primary_key("part_pk", "p_partkey"),
        ]),
    }
    out = None
    for name, rep in reports.items():
        r = rep.select(F.lit(name).alias("table_name"), "*")
        out = r if out is None else out.unionByName(r)
    return out


@query("constraint_report")
def constraint_report(spark, sf):
    return constraint_checks(spark, sf)


@query("fk_violations")
def fk_violations(spark, sf):
    li = t(spark, sf, "lineitem")
    good = t(spark, sf, "supplier").filter(F.col("s_acctbal") >= 0)
    orphans = quality.fk_orphans(li, ["l_suppkey"], good, ["s_suppkey"])
    return orphans.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("orphan_lines"))


@query("pk_duplicates")
def pk_duplicates(spark, sf):
    return quality.duplicate_keys(t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("source_union")
def source_union(spark, sf):
    ev = with_row_id(t(spark, sf, "events"))
    app = ev.filter(F.col("event_type").isin("click", "view", "purchase")).select(
        "event_id", "user_id", "event_type", "value", "_rid_file", "_rid_row")
    backend = ev.filter(F.col("event_type").isin("purchase", "signup", "error")).select(
        "value", "event_type", "user_id", "event_id", "_rid_file", "_rid_row")
    out = prioritized_union({"app": app, "backend": backend}, ["event_id"], ["backend", "app"],
                            ["_rid_file", "_rid_row"])
    return out.select("event_id", "user_id", "event_type", "value", "source_system")


attach({
    "q1_top_orders": """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_nationkey, o.o_totalprice
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE o.o_orderstatus = 'F' ORDER BY o.o_totalprice DESC, o.o_orderkey LIMIT 10""",
    "q2_no_activity": """
SELECT c.c_mktsegment, COUNT(*) AS customers_without_events
FROM customer c LEFT JOIN events e ON e.user_id = c.c_custkey
WHERE e.event_id IS NULL GROUP BY c.c_mktsegment""",
    "q3_having": """
SELECT n.n_name, COUNT(*) AS f_orders,
       ROUND(CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 4) AS avg_totalprice
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE o.o_orderstatus = 'F' GROUP BY n.n_name HAVING COUNT(*) >= 200 ORDER BY avg_totalprice DESC, n.n_name""",
    "q4_tiers": """
SELECT CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium'
            ELSE 'large' END AS price_tier, COUNT(*) AS orders
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY 1""",
    "q5_histogram": """
WITH per_cust AS (SELECT o_custkey, COUNT(*) AS order_count FROM orders GROUP BY o_custkey)
SELECT order_count, COUNT(*) AS customers FROM per_cust GROUP BY order_count ORDER BY order_count""",
    "q6_what_if": """
WITH target AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
                WHERE o_orderkey = (SELECT MIN(o_orderkey) FROM orders WHERE o_orderstatus = 'F'))
SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(NULL AS DATE) AS end_date, 'before' AS stage FROM target
UNION ALL
SELECT o_orderkey, 'X', o_orderdate, last_day(o_orderdate + INTERVAL 2 MONTH), 'what_if' FROM target""",
    "point_lookup": """
SELECT * FROM lineitem
WHERE l_orderkey = (SELECT MIN(o_orderkey) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
  AND l_linestatus = 'F'""",
    "join_order_preview": """
SELECT s.s_suppkey, s.s_name, n.n_name, s.s_acctbal
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey ORDER BY n.n_name, s.s_suppkey""",
    "standardize_text": """
WITH raw AS (
  SELECT '  ' || CAST(o_orderkey AS VARCHAR) || ' ' AS orderkey_txt,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS custkey_txt,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price_txt,
         CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%m/%d/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_txt,
         ' ' || lower(o_orderpriority) AS priority_txt
  FROM orders)
SELECT TRY_CAST(NULLIF(TRIM(orderkey_txt), '') AS BIGINT) AS o_orderkey,
       TRY_CAST(NULLIF(TRIM(custkey_txt), '') AS BIGINT) AS o_custkey,
       TRY_CAST(NULLIF(TRIM(price_txt), '') AS DECIMAL(12,2)) AS o_totalprice,
       TRY_CAST(NULLIF(TRIM(date_txt), '') AS DATE) AS o_orderdate,
       upper(NULLIF(TRIM(priority_txt), '')) AS o_orderpriority
FROM raw""",
    "standardize_unparseable": """
WITH raw AS (
  SELECT '  ' || CAST(o_orderkey AS VARCHAR) || ' ' AS orderkey_txt,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS custkey_txt,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price_txt,
         CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%m/%d/%Y')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_txt,
         ' ' || lower(o_orderpriority) AS priority_txt
  FROM orders),
bad AS (
  SELECT (NULLIF(TRIM(orderkey_txt), '') IS NOT NULL AND TRY_CAST(NULLIF(TRIM(orderkey_txt), '') AS BIGINT) IS NULL)
      OR (NULLIF(TRIM(custkey_txt), '') IS NOT NULL AND TRY_CAST(NULLIF(TRIM(custkey_txt), '') AS BIGINT) IS NULL)
      OR (NULLIF(TRIM(price_txt), '') IS NOT NULL AND TRY_CAST(NULLIF(TRIM(price_txt), '') AS DECIMAL(12,2)) IS NULL)
      OR (NULLIF(TRIM(date_txt), '') IS NOT NULL AND TRY_CAST(NULLIF(TRIM(date_txt), '') AS DATE) IS NULL) AS b
  FROM raw)
SELECT CASE WHEN b THEN 'UNPARSEABLE_VALUE' ELSE 'ACCEPTED' END AS outcome, COUNT(*) AS n_rows FROM bad GROUP BY 1""",
    "constraint_report": """
WITH good_cust AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
SELECT 'orders' AS table_name, 'orders_pk' AS "constraint", 'pk' AS kind,
       CAST(COALESCE(SUM(CASE WHEN o_orderkey IS NULL OR n > 1 THEN n END), 0) AS BIGINT) AS violations
FROM (SELECT o_orderkey, COUNT(*) AS n FROM orders GROUP BY o_orderkey)
UNION ALL SELECT 'orders', 'orders_customer_fk', 'fk', COUNT(*) FROM orders o
  WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM good_cust g WHERE g.c_custkey = o.o_custkey)
UNION ALL SELECT 'orders', 'orders_status_in', 'check',
  COUNT(*) FILTER (WHERE NOT COALESCE(o_orderstatus IN ('F', 'O', 'P'), TRUE)) FROM orders
UNION ALL SELECT 'orders', 'orders_date_not_null', 'not_null', COUNT(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'lineitem', 'lineitem_pk', 'pk',
  CAST(COALESCE(SUM(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL OR n > 1 THEN n END), 0) AS BIGINT)
  FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'lineitem', 'lineitem_orders_fk', 'fk', COUNT(*) FROM lineitem l
  WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'lineitem', 'lineitem_discount_le_tax', 'check',
  COUNT(*) FILTER (WHERE NOT COALESCE(l_discount <= l_tax, TRUE)) FROM lineitem
UNION ALL SELECT 'lineitem', 'lineitem_quantity_between', 'check',
  COUNT(*) FILTER (WHERE NOT COALESCE(l_quantity BETWEEN 1 AND 49, TRUE)) FROM lineitem
UNION ALL SELECT 'customer', 'customer_name_segment_unique', 'unique',
  CAST(COALESCE(SUM(CASE WHEN c_name IS NOT NULL AND c_mktsegment IS NOT NULL AND n > 1 THEN n END), 0) AS BIGINT)
  FROM (SELECT c_name, c_mktsegment, COUNT(*) AS n FROM customer GROUP BY c_name, c_mktsegment)
UNION ALL SELECT 'customer', 'customer_balance_ge_0', 'check',
  COUNT(*) FILTER (WHERE NOT COALESCE(c_acctbal >= 0, TRUE)) FROM customer
UNION ALL SELECT 'customer', 'customer_name_len', 'max_length',
  COUNT(*) FILTER (WHERE length(c_name) > 17) FROM customer
UNION ALL SELECT 'part', 'part_size_between', 'check',
  COUNT(*) FILTER (WHERE NOT COALESCE(p_size BETWEEN 1 AND 50, TRUE)) FROM part
UNION ALL SELECT 'part', 'part_pk', 'pk',
  CAST(COALESCE(SUM(CASE WHEN p_partkey IS NULL OR n > 1 THEN n END), 0) AS BIGINT)
  FROM (SELECT p_partkey, COUNT(*) AS n FROM part GROUP BY p_partkey)""",
    "fk_violations": """
SELECT l.l_suppkey, COUNT(*) AS orphan_lines FROM lineitem l
WHERE l.l_suppkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey AND s.s_acctbal >= 0)
GROUP BY l.l_suppkey""",
    "pk_duplicates": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "source_union": """
WITH tagged AS (
  SELECT event_id, user_id, event_type, value, 'app' AS source_system, 1 AS r FROM events
  WHERE event_type IN ('click', 'view', 'purchase')
  UNION ALL
  SELECT event_id, user_id, event_type, value, 'backend', 0 FROM events
  WHERE event_type IN ('purchase', 'signup', 'error'))
SELECT event_id, user_id, event_type, value, source_system FROM tagged
QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY r) = 1""",
})
