"""Data-quality classification of order lines (the curated-ETL job on the analytic tables).

Role mapping: enrollment → lineitem (key l_orderkey, l_linenumber), member →
supplier, plan → part, effective date → o_orderdate, end date → l_shipdate.
Parents are filtered (suppliers with a non-negative balance, parts of size
≥ 3) so that referential failures exist; ``l_quantity = 1`` stands for a
missing value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.rules import Rule, any_null, classify, flag_exists, flag_first, flag_first_once, reason
from ..session import materialize
from .common import t
from .registry import query

KEY = ["l_orderkey", "l_linenumber"]
DUP_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
ROW_ID = ["_rid_file", "_rid_row"]

# Rejection reasons in rule order.
REASONS = ["MISSING_REQUIRED_FIELD", "INVALID_SUPPLIER_ID", "INVALID_PART_ID", "NEGATIVE_PREMIUM",
           "INVALID_STATUS", "INVALID_DATE_RANGE", "DUPLICATE_LINEITEM"]

LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "o_orderdate", "premium"]


def with_order_date(li: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Attach o_orderdate by a left lookup: a line without an order is kept (and
    rejected as missing a required field) instead of silently vanishing before
    the counts are reconciled. Order keys are unique, so rows stay 1:1."""
    orders = t(spark, sf, "orders").select(F.col("o_orderkey"), F.col("o_orderdate"))
    return li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "left").drop("o_orderkey")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """The incoming rows: every lineitem row (with its row id) and its order date."""
    return with_order_date(t(spark, sf, "lineitem", row_id=True), spark, sf)


def prepare(df: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Standardized measures and both existence flags for line-shaped rows."""
    df = (df.withColumn("qty", F.nullif(F.col("l_quantity"), F.lit(1.0)))
          .withColumn("premium", (F.col("l_extendedprice").cast("decimal(12,2)")
                                  - F.lit(50) * F.col("l_quantity").cast("decimal(12,2)")).cast("decimal(18,2)")))
    suppliers = t(spark, sf, "supplier").filter(F.col("s_acctbal") >= 0)
    parts = t(spark, sf, "part").filter(F.col("p_size") >= 3)
    df = flag_exists(df, suppliers, [("l_suppkey", "s_suppkey")], "_supplier_ok")
    return flag_exists(df, parts, [("l_partkey", "p_partkey")], "_part_ok")


def dq_input(spark: SparkSession, sf: str) -> DataFrame:
    return prepare(lines(spark, sf), spark, sf)


def row_rules() -> list[Rule]:
    return [
        Rule("MISSING_REQUIRED_FIELD", any_null("qty", "o_orderdate")),
        Rule("INVALID_SUPPLIER_ID", ~F.col("_supplier_ok")),
        Rule("INVALID_PART_ID", ~F.col("_part_ok")),
        Rule("NEGATIVE_PREMIUM", F.col("premium") < 0),
        Rule("INVALID_STATUS", ~F.col("l_returnflag").isin("A", "N") & (F.col("l_linestatus") == "F")
             & (F.col("l_tax") > 0.06)),
        Rule("INVALID_DATE_RANGE", F.col("l_shipdate") < F.col("o_orderdate") - F.expr("INTERVAL 3 YEARS")),
    ]


def classify_lines(df: DataFrame, dedupe_scope: str = "all", row_id=ROW_ID) -> DataFrame:
    """Apply the seven ordered rules to prepared rows; dedupe over all rows
    (as the reference job) or only over rows passing the other rules."""
    rules = row_rules()
    if dedupe_scope == "all":
        df = flag_first_once(df, KEY, DUP_ORDER, list(row_id), flag="_first")
    else:
        df = flag_first(df, KEY, DUP_ORDER, list(row_id), flag="_first", scope=reason(rules).isNull())
    rules.append(Rule("DUPLICATE_LINEITEM", ~F.col("_first")))
    return classify(df, rules)


def classified(spark: SparkSession, sf: str, dedupe_scope: str = "all", once: bool = False) -> DataFrame:
    """All incoming rows with ``rejection_reason`` (NULL = accepted). Jobs that shuffle or write all
    rows afterwards rank them with one shuffle (``once``)."""
    if dedupe_scope != "all":
        # the rank needs the flags of the joined rows, so these are written once
        return classify_lines(materialize(dq_input(spark, sf), "dq"), dedupe_scope)
    if once:
        # the lookup of the order date shuffles the lines by order, and they are ranked where they lie then
        li = flag_first_once(t(spark, sf, "lineitem", row_id=True), KEY, DUP_ORDER, ROW_ID, flag="_first", by=KEY[:1],
                             then=lambda rows: with_order_date(rows, spark, sf))
    else:
        # The rank over all rows needs only lineitem columns, so it is computed on
        # the scan itself (its aggregate branch reads lineitem alone); the 1:1
        # lookup and the existence flags follow.
        li = with_order_date(flag_first(t(spark, sf, "lineitem", row_id=True), KEY, DUP_ORDER, ROW_ID, flag="_first"), spark, sf)
    rules = row_rules() + [Rule("DUPLICATE_LINEITEM", ~F.col("_first"))]
    return classify(prepare(li, spark, sf), rules)


@query("dq_rejections_by_reason", oracle=None)
def dq_rejections_by_reason(spark, sf):
    return quality.by_reason(classified(spark, sf))


@query("dq_accepted")
def dq_accepted(spark, sf):
    acc, _ = quality.split(classified(spark, sf))
    return acc.select(*LINE_COLS)


@query("dq_rejected")
def dq_rejected(spark, sf):
    _, rej = quality.split(classified(spark, sf))
    return rej.select(*LINE_COLS, "rejection_reason")


@query("dq_summary")
def dq_summary(spark, sf):
    return quality.summary(classified(spark, sf))


@query("dq_dedupe_valid_scope")
def dq_dedupe_valid_scope(spark, sf):
    return quality.by_reason(classified(spark, sf, dedupe_scope="valid"), reasons=REASONS)


@query("curated_enriched")
def curated_enriched(spark, sf):
    acc, _ = quality.split(classified(spark, sf))
    part = t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    supp = (t(spark, sf, "supplier").join(t(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "n_name"))
    return (acc.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "premium", "l_linestatus")
            .join(part, "l_partkey", "left").join(supp, "l_suppkey", "left")
            .withColumn("is_open", F.col("l_linestatus") == "O")
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "premium",
                    "p_brand", "p_type", "s_name", "n_name", "is_open"))


# Which fault each selector value injects (selector = (7·orderkey + linenumber) mod 50).
FAULT_SLOTS = {0: "MISSING_REQUIRED_FIELD", 1: "INVALID_SUPPLIER_ID", 2: "INVALID_PART_ID",
               3: "NEGATIVE_PREMIUM", 4: "INVALID_STATUS", 5: "INVALID_DATE_RANGE", 6: "DUPLICATE_LINEITEM"}


@query("fault_injection")
def fault_injection(spark, sf):
    """Labelled faults injected into the accepted rows, reclassified: confusion counts."""
    acc, _ = quality.split(classified(spark, sf, once=True))
    base = materialize(acc.select(*[c for c in lines(spark, sf).columns]), "accepted")    # read by every branch below
    slot = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(50))
    lab = {v: k for k, v in FAULT_SLOTS.items()}
    faults = [
        quality.Fault("MISSING_REQUIRED_FIELD", slot == lab["MISSING_REQUIRED_FIELD"], {"l_quantity": F.lit(1.0)}),
        quality.Fault("INVALID_SUPPLIER_ID", slot == lab["INVALID_SUPPLIER_ID"], {"l_suppkey": F.lit(-1).cast("bigint")}),
        quality.Fault("INVALID_PART_ID", slot == lab["INVALID_PART_ID"], {"l_partkey": F.lit(-1).cast("bigint")}),
        quality.Fault("NEGATIVE_PREMIUM", slot == lab["NEGATIVE_PREMIUM"], {"l_extendedprice": F.lit(0.0)}),
        quality.Fault("INVALID_STATUS", slot == lab["INVALID_STATUS"],
                      {"l_returnflag": F.lit("R"), "l_linestatus": F.lit("F"), "l_tax": F.lit(0.08)}),
        quality.Fault("INVALID_DATE_RANGE", slot == lab["INVALID_DATE_RANGE"],
                      {"l_shipdate": F.col("o_orderdate") - F.expr("INTERVAL 4 YEARS")}),
        quality.Fault("DUPLICATE_LINEITEM", slot == lab["DUPLICATE_LINEITEM"], duplicate=True),
    ]
    injected = quality.inject_faults(base, faults, label_col="expected_reason", copy_col="_copy")
    cls = classify_lines(prepare(injected, spark, sf), row_id=[*ROW_ID, "_copy"])
    return (cls.groupBy(F.coalesce(F.col("expected_reason"), F.lit("NONE")).alias("expected_reason"),
                        F.coalesce(F.col("rejection_reason"), F.lit("ACCEPTED")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


# ------------------------------------------------------------------ oracles
DQ_CTE = """
WITH dq_in AS (
  SELECT l.*, o.o_orderdate,
         NULLIF(l.l_quantity, 1) AS qty,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) - 50 * CAST(l.l_quantity AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS premium,
         EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey AND s.s_acctbal >= 0) AS supplier_ok,
         EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size >= 3) AS part_ok
  FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
), pre AS (
  SELECT *, CASE
      WHEN qty IS NULL OR o_orderdate IS NULL THEN 'MISSING_REQUIRED_FIELD'
      WHEN NOT supplier_ok THEN 'INVALID_SUPPLIER_ID'
      WHEN NOT part_ok THEN 'INVALID_PART_ID'
      WHEN premium < 0 THEN 'NEGATIVE_PREMIUM'
      WHEN l_returnflag NOT IN ('A', 'N') AND l_linestatus = 'F' AND l_tax > 0.06 THEN 'INVALID_STATUS'
      WHEN l_shipdate < o_orderdate - INTERVAL 3 YEAR THEN 'INVALID_DATE_RANGE'
    END AS pre_reason
  FROM dq_in
), classified AS (
  SELECT *, COALESCE(pre_reason, CASE WHEN ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
                 l_returnflag, l_linestatus) > 1 THEN 'DUPLICATE_LINEITEM' END) AS rejection_reason
  FROM pre
)
"""

# The duplicate rank among rows that pass the other rules only.
DQ_VALID_CTE = """
WITH dq_in AS (
  SELECT l.*, o.o_orderdate,
         NULLIF(l.l_quantity, 1) AS qty,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) - 50 * CAST(l.l_quantity AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS premium,
         EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey AND s.s_acctbal >= 0) AS supplier_ok,
         EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size >= 3) AS part_ok
  FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
), pre AS (
  SELECT *, CASE
      WHEN qty IS NULL OR o_orderdate IS NULL THEN 'MISSING_REQUIRED_FIELD'
      WHEN NOT supplier_ok THEN 'INVALID_SUPPLIER_ID'
      WHEN NOT part_ok THEN 'INVALID_PART_ID'
      WHEN premium < 0 THEN 'NEGATIVE_PREMIUM'
      WHEN l_returnflag NOT IN ('A', 'N') AND l_linestatus = 'F' AND l_tax > 0.06 THEN 'INVALID_STATUS'
      WHEN l_shipdate < o_orderdate - INTERVAL 3 YEAR THEN 'INVALID_DATE_RANGE'
    END AS pre_reason
  FROM dq_in
), ranked AS (
  SELECT *, ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber, pre_reason IS NULL
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
                 l_returnflag, l_linestatus) AS rn
  FROM pre
), classified AS (
  SELECT *, COALESCE(pre_reason, CASE WHEN rn > 1 THEN 'DUPLICATE_LINEITEM' END) AS rejection_reason
  FROM ranked
)
"""

_LINE_SQL = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, "
             "l_tax, l_returnflag, l_linestatus, l_shipdate, o_orderdate, premium")

ORACLE = {
    "dq_rejections_by_reason": DQ_CTE + """
SELECT rejection_reason, COUNT(*) AS rejected_count FROM classified
WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason""",
    "dq_accepted": DQ_CTE + f"SELECT {_LINE_SQL} FROM classified WHERE rejection_reason IS NULL",
    "dq_rejected": DQ_CTE + f"SELECT {_LINE_SQL}, rejection_reason FROM classified WHERE rejection_reason IS NOT NULL",
    "dq_summary": DQ_CTE + """
SELECT COUNT(*) AS extracted,
       COUNT(*) FILTER (WHERE rejection_reason IS NULL) AS accepted,
       COUNT(*) FILTER (WHERE rejection_reason IS NOT NULL) AS rejected,
       ROUND(CAST(COUNT(*) FILTER (WHERE rejection_reason IS NULL) AS DOUBLE) / COUNT(*), 4) AS pass_rate
FROM classified""",
    "dq_dedupe_valid_scope": DQ_VALID_CTE + """
SELECT r.rejection_reason, CAST(COUNT(c.rejection_reason) AS BIGINT) AS rejected_count
FROM (VALUES ('MISSING_REQUIRED_FIELD'), ('INVALID_SUPPLIER_ID'), ('INVALID_PART_ID'), ('NEGATIVE_PREMIUM'),
             ('INVALID_STATUS'), ('INVALID_DATE_RANGE'), ('DUPLICATE_LINEITEM')) r(rejection_reason)
LEFT JOIN classified c ON c.rejection_reason = r.rejection_reason
GROUP BY r.rejection_reason""",
    "fault_injection": DQ_CTE.rstrip().rstrip(")") + """),
acc AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, l_shipdate, o_orderdate, (l_orderkey * 7 + l_linenumber) % 50 AS slot
        FROM classified WHERE rejection_reason IS NULL),
inj AS (
  SELECT l_orderkey,
         CASE WHEN slot = 2 THEN -1 ELSE l_partkey END AS l_partkey,
         CASE WHEN slot = 1 THEN -1 ELSE l_suppkey END AS l_suppkey,
         l_linenumber,
         CASE WHEN slot = 0 THEN 1.0 ELSE l_quantity END AS l_quantity,
         CASE WHEN slot = 3 THEN 0.0 ELSE l_extendedprice END AS l_extendedprice,
         l_discount,
         CASE WHEN slot = 4 THEN 0.08 ELSE l_tax END AS l_tax,
         CASE WHEN slot = 4 THEN 'R' ELSE l_returnflag END AS l_returnflag,
         CASE WHEN slot = 4 THEN 'F' ELSE l_linestatus END AS l_linestatus,
         CASE WHEN slot = 5 THEN o_orderdate - INTERVAL 4 YEAR ELSE l_shipdate END AS l_shipdate,
         o_orderdate,
         CASE slot WHEN 0 THEN 'MISSING_REQUIRED_FIELD' WHEN 1 THEN 'INVALID_SUPPLIER_ID' WHEN 2 THEN 'INVALID_PART_ID'
                   WHEN 3 THEN 'NEGATIVE_PREMIUM' WHEN 4 THEN 'INVALID_STATUS' WHEN 5 THEN 'INVALID_DATE_RANGE' END
           AS expected_reason,
         0 AS copy_no
  FROM acc
  UNION ALL
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, l_shipdate, o_orderdate, 'DUPLICATE_LINEITEM', 1
  FROM acc WHERE slot = 6),
chk AS (
  SELECT i.*, NULLIF(l_quantity, 1) AS qty,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - 50 * CAST(l_quantity AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS premium,
         EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = i.l_suppkey AND s.s_acctbal >= 0) AS supplier_ok,
         EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = i.l_partkey AND p.p_size >= 3) AS part_ok,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount,
                                     l_tax, l_returnflag, l_linestatus, copy_no) AS rn
  FROM inj i)
SELECT COALESCE(expected_reason, 'NONE') AS expected_reason,
       COALESCE(CASE
         WHEN qty IS NULL OR o_orderdate IS NULL THEN 'MISSING_REQUIRED_FIELD'
         WHEN NOT supplier_ok THEN 'INVALID_SUPPLIER_ID'
         WHEN NOT part_ok THEN 'INVALID_PART_ID'
         WHEN premium < 0 THEN 'NEGATIVE_PREMIUM'
         WHEN l_returnflag NOT IN ('A', 'N') AND l_linestatus = 'F' AND l_tax > 0.06 THEN 'INVALID_STATUS'
         WHEN l_shipdate < o_orderdate - INTERVAL 3 YEAR THEN 'INVALID_DATE_RANGE'
         WHEN rn > 1 THEN 'DUPLICATE_LINEITEM' END, 'ACCEPTED') AS outcome,
       COUNT(*) AS n_rows
FROM chk GROUP BY 1, 2""",
    "curated_enriched": DQ_CTE + """
SELECT c.l_orderkey, c.l_linenumber, c.l_partkey, c.l_suppkey, c.premium, p.p_brand, p.p_type,
       s.s_name, n.n_name, c.l_linestatus = 'O' AS is_open
FROM classified c
LEFT JOIN part p ON p.p_partkey = c.l_partkey
LEFT JOIN (supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey) ON s.s_suppkey = c.l_suppkey
WHERE c.rejection_reason IS NULL""",
}

from .registry import attach  # noqa: E402

attach(ORACLE)
