"""File-based operators: landing + manifest, latest batch, guarded append, clustered layout,
curate job. Each run writes under a fresh folder in the cluster checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from .. import jobs
from ..functions.text import Field, standardize
from ..functions.expr import batch_id, hex_text, money_text
from ..operators import quality
from ..operators.layout import write_clustered
from ..session import materialize, scratch_dir
from ..sources import landing, raw
from . import dq
from .common import t
from .registry import attach, query

# Batch ids used by the landing demos.
RUN_1, RUN_2 = "20240101T000000Z", "20240102T000000Z"
LANDED = [("tpch", "customer"), ("tpch", "orders"), ("tpch", "lineitem")]


@query("manifest_reconcile")
def manifest_reconcile(spark, sf):
    root = scratch_dir(spark, "raw")
    mpath = landing.land_all(spark, {(s, n): t(spark, sf, n) for s, n in LANDED}, root, RUN_1, checksums=False)
    manifest = raw.read_manifest(spark, mpath)
    landed = landing.landed_counts(spark, root, LANDED)
    rec = landing.reconcile_manifest(manifest, landed)
    return rec.select(F.col("table").alias("table_name"), "manifest_rows", "landed_rows", "status")


@query("manifest_totals")
def manifest_totals(spark, sf):
    """Files and rows of a landing run, from its manifest alone."""
    root = scratch_dir(spark, "raw")
    mpath = landing.land_all(spark, {(s, n): t(spark, sf, n) for s, n in LANDED}, root, RUN_1, checksums=False)
    return raw.manifest_totals(raw.read_manifest(spark, mpath))


@query("land_documents")
def land_documents(spark, sf):
    """Texts with line breaks, quotes and backslashes landed as CSV and read back whole."""
    root = scratch_dir(spark, "raw")
    docs = t(spark, sf, "documents")
    # some texts made NULL or empty, which the file has to tell apart
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 50 == 0, F.lit(None)).when(F.col("doc_id") % 50 == 1, F.lit(""))
                           .otherwise(F.concat("text", F.lit('\r\n\\n "q", \\'))))
    landing.land(docs, root, "feed", "documents", RUN_1)
    return raw.read_latest(spark, os.path.join(root, "feed", "documents"), docs.columns).drop("source_file", "batch")


ORDER_TEXT_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
ORDER_TYPES = [Field("o_orderkey", "bigint"), Field("o_custkey", "bigint"), Field("o_orderstatus"),
               Field("o_totalprice", "decimal(12,2)"), Field("o_orderdate", "date")]


@query("latest_batch")
def latest_batch(spark, sf):
    root = scratch_dir(spark, "raw")
    o = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                      F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
                                      F.col("o_orderdate").cast("date").alias("o_orderdate"))
    landing.land(o.filter(F.col("o_orderstatus") == "F"), root, "erp", "orders", RUN_1)
    landing.land(o.filter(F.col("o_orderstatus") != "F"), root, "erp", "orders", RUN_2)
    latest = raw.read_latest(spark, os.path.join(root, "erp", "orders"), ORDER_TEXT_COLS)
    return standardize(latest, ORDER_TYPES, keep=["batch"])


@query("idempotent_append")
def idempotent_append(spark, sf):
    target = scratch_dir(spark, "curated")
    cust = t(spark, sf, "customer")
    landing.append_new(cust, target, ["c_custkey"])
    landing.append_new(cust, target, ["c_custkey"])       # second run adds nothing
    return spark.read.parquet(target)


@query("clustered_lookup")
def clustered_lookup(spark, sf):
    path = scratch_dir(spark, "clustered")
    write_clustered(t(spark, sf, "lineitem"), path, ["l_shipdate"])
    li = spark.read.parquet(path)
    return li.filter((F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
                     & (F.col("l_shipdate") < F.lit("1995-04-01").cast("timestamp_ntz")))


@query("curate_job")
def curate_job(spark, sf):
    """Classify → one observed write (accepted / rejected partitions) → reconcile →
    DQ tables from what was written; returns the written dq_summary."""
    root = scratch_dir(spark, "lake")
    counts = jobs.curate(dq.classified(spark, sf, once=True), root, columns=dq.LINE_COLS, expected_rows=t(spark, sf, "lineitem"))
    return (spark.read.parquet(os.path.join(root, "dq_summary"))
            .withColumn("observed_extracted", F.lit(counts["extracted"]).cast("bigint")))


@query("curate_job_rows")
def curate_job_rows(spark, sf):
    """The rows the curate job wrote, accepted and rejected, each with its reason."""
    root = scratch_dir(spark, "lake")
    jobs.curate(dq.classified(spark, sf, once=True), root, columns=dq.LINE_COLS, expected_rows=t(spark, sf, "lineitem"))
    return spark.read.parquet(os.path.join(root, "classified"))


@query("quarantine_csv")
def quarantine_csv(spark, sf):
    """Rejected rows as a text zone, read back: keys, offending values and reason."""
    root = scratch_dir(spark, "quarantine")
    _, rejected = quality.split(dq.classified(spark, sf))
    landing.write_quarantine(rejected.select("l_orderkey", "l_linenumber", "l_returnflag", "rejection_reason"), root, fmt="csv")
    return raw.read_raw(spark, root, ["l_orderkey", "l_linenumber", "l_returnflag", "rejection_reason"], provenance=False, landed=True)


@query("typed_csv_load")
def typed_csv_load(spark, sf):
    """A bulk load with declared types from a CSV another writer left."""
    path = scratch_dir(spark, "csv")
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice decimal(12,2), o_orderdate date"
    typed = t(spark, sf, "orders").select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in schema.split(", ")])
    typed.write.option("header", True).csv(path)
    return raw.read_typed_csv(spark, path, schema)


@query("positional_load")
def positional_load(spark, sf):
    """Columns taken by position under the names of the target table."""
    path = scratch_dir(spark, "positional")
    t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey").write.parquet(path)
    return raw.read_positional(spark, path, ["supplier_key", "supplier_name", "nation_key"])


@query("zone_views")
def zone_views(spark, sf):
    """Datasets of a zone found by listing it and read as SQL views."""
    root = scratch_dir(spark, "zone")
    t(spark, sf, "customer").write.parquet(f"{root}/zone_customer")
    t(spark, sf, "orders").write.parquet(f"{root}/zone_orders")
    raw.register_zone(spark, root)
    return spark.sql("""SELECT c_nationkey, COUNT(*) AS n_orders FROM zone_orders JOIN zone_customer ON o_custkey = c_custkey
                        GROUP BY c_nationkey""")


class _Killed(RuntimeError):
    pass


@query("landing_commit")
def landing_commit(spark, sf):
    """A second landing dies before its manifest: readers keep the first one whole; its rerun shows the second one whole."""
    root = scratch_dir(spark, "raw")
    first = {("erp", "orders"): t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F"),
             ("erp", "lineitem"): t(spark, sf, "lineitem").filter(F.col("l_linestatus") == "F")}
    second = {("erp", n): t(spark, sf, n) for n in ("orders", "lineitem")}

    def dies():
        raise _Killed

    def seen(step):
        stages = {n: raw.read_latest(spark, os.path.join(root, "erp", n)) for n in ("orders", "lineitem")}
        return materialize(quality.stage_counts(stages).withColumn("step", F.lit(step)), "seen")

    landing.land_all(spark, first, root, RUN_1)
    try:
        landing.land_all(spark, second, root, RUN_2, before_commit=dies)
    except _Killed:
        pass
    before = seen("killed")
    landing.land_all(spark, second, root, RUN_2)
    return before.unionByName(seen("again"))


@query("landing_changes")
def landing_changes(spark, sf):
    """Two landings of a change log beside a full table: the second one extracts what lies beyond the mark."""
    from .cdc import HI, change_log
    root = scratch_dir(spark, "raw")
    log, key = change_log(spark, sf), ("erp", "events_ct")
    full = {("erp", "customer"): t(spark, sf, "customer")}
    landing.land_all(spark, full, root, RUN_1, {key: log.filter(F.col("lsn") < F.lit(HI).cast("timestamp_ntz"))})
    landing.land_all(spark, full, root, RUN_2, {key: log})
    rows = raw.read_raw(spark, os.path.join(root, *key), landed=True, provenance=False)
    return rows.groupBy("batch").agg(F.count(F.lit(1)).alias("changes"), F.max(F.col("lsn").cast("timestamp_ntz")).alias("mark"))


@query("landing_checksums")
def landing_checksums(spark, sf):
    """Every landed file against the checksum that its landing left."""
    root = scratch_dir(spark, "raw")
    tables = {("tpch", n): t(spark, sf, n) for n in ("orders", "lineitem", "documents")}
    landing.land_all(spark, tables, root, RUN_1)
    files = landing.reconcile_files(spark, root, RUN_1, list(tables))
    return files.groupBy("key", "status").agg(F.sum("rows_now").alias("n_rows"))


@query("partition_refresh")
def partition_refresh(spark, sf):
    """One month of the orders loaded again with other prices; the other months' files stay."""
    path = f"{scratch_dir(spark, 'zone')}/orders"
    o = t(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
                                      F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    landing.overwrite_partitions(o, path, ["month"])
    again = o.filter(F.col("month") == "1995-03").withColumn("price", (F.col("price") * 2).cast("decimal(12,2)"))
    landing.overwrite_partitions(again, path, ["month"])
    return spark.read.schema("o_orderkey long, price decimal(12,2), month string").parquet(path)


@query("default_values")
def default_values(spark, sf):
    """Blank text becomes NULL, and NULL the column's default."""
    o = t(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderstatus") == "O", F.lit("  ")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") < 50000, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("price"))
    return standardize(o, [Field("order_id", "bigint"), Field("status", default="'open'"),
                           Field("price", "decimal(12,2)", default="0")])


@query("text_formats")
def text_formats(spark, sf):
    """Money text, hex text and batch ids of order values."""
    return t(spark, sf, "orders").select(
        "o_orderkey", money_text(F.col("o_totalprice")).alias("price_text"),
        hex_text(F.col("o_orderkey").cast("string").cast("binary")).alias("key_hex"),
        batch_id(F.col("o_orderdate").cast("timestamp")).alias("batch"))


def _load_star(spark, sf, root):
    from .star import fact_base
    return jobs.load_star(fact_base(spark, sf), [
        jobs.Dimension("dim_part", t(spark, sf, "part"), ["p_partkey"], ["p_brand", "p_type", "p_size"],
                       "part_key", [("l_partkey", "p_partkey")]),
        jobs.Dimension("dim_customer", t(spark, sf, "customer"), ["c_custkey"], ["c_nationkey", "c_mktsegment"],
                       "customer_key", [("o_custkey", "c_custkey")], bring=["c_nationkey"]),
        jobs.Dimension("dim_nation", t(spark, sf, "nation").join(t(spark, sf, "region"),
                                                                  F.col("n_regionkey") == F.col("r_regionkey"), "left"),
                       ["n_nationkey"], ["n_name", "r_name"], "nation_key", [("c_nationkey", "n_nationkey")]),
    ], root, "fact_sales", fact_cols=["l_orderkey", "l_linenumber", "part_key", "customer_key", "nation_key",
                                      "l_quantity", "amount", "line_count", "is_open"])


@query("star_load")
def star_load(spark, sf):
    """Dimensions and fact written to the warehouse folder; stage counts read back."""
    return _load_star(spark, sf, scratch_dir(spark, "warehouse"))


@query("star_load_rows")
def star_load_rows(spark, sf):
    """The fact rows the star load wrote."""
    root = scratch_dir(spark, "warehouse")
    _load_star(spark, sf, root)
    return spark.read.parquet(os.path.join(root, "fact_sales"))


def _star_dims():
    from .star import _DIMS
    return _DIMS


attach({
    "manifest_reconcile": """
SELECT 'customer' AS table_name, COUNT(*) AS manifest_rows, COUNT(*) AS landed_rows, 'match' AS status FROM customer
UNION ALL SELECT 'orders', COUNT(*), COUNT(*), 'match' FROM orders
UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*), 'match' FROM lineitem""",
    "latest_batch": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, '20240102T000000Z' AS batch
FROM orders WHERE o_orderstatus <> 'F'""",
    "idempotent_append": "SELECT * FROM customer",
    "clustered_lookup": """
SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1995-04-01'""",
    "manifest_totals": """
SELECT '20240101T000000Z' AS run_ts, CAST(3 AS BIGINT) AS files,
       CAST((SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM lineitem) AS BIGINT)
         AS total_rows""",
    "land_documents": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id,
       CASE WHEN doc_id % 50 = 0 THEN NULL WHEN doc_id % 50 = 1 THEN ''
            ELSE text || chr(13) || chr(10) || '\\n "q", \\' END AS text,
       lang, source, CAST(n_chars AS VARCHAR) AS n_chars
FROM documents""",
    "curate_job_rows": dq.DQ_CTE + f"""SELECT {dq._LINE_SQL}, rejection_reason,
       CASE WHEN rejection_reason IS NULL THEN 'accepted' ELSE 'rejected' END AS dq_status FROM classified""",
    "quarantine_csv": dq.DQ_CTE + """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
       CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag, rejection_reason
FROM classified WHERE rejection_reason IS NOT NULL""",
    "typed_csv_load": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""",
    "positional_load": "SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_nationkey AS nation_key FROM supplier",
    "zone_views": """
SELECT c_nationkey, COUNT(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""",
    "landing_commit": """
SELECT 'killed' AS step, 'orders' AS table_name, COUNT(*) AS row_count FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'killed', 'lineitem', COUNT(*) FROM lineitem WHERE l_linestatus = 'F'
UNION ALL SELECT 'again', 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'again', 'lineitem', COUNT(*) FROM lineitem""",
    "landing_changes": """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-12 00:00:00' THEN '20240101T000000Z' ELSE '20240102T000000Z' END AS batch,
       COUNT(*) AS changes, MAX(ts) AS mark
FROM events GROUP BY 1""",
    "landing_checksums": """
SELECT 'tpch/orders/batch=20240101T000000Z' AS key, 'match' AS status, COUNT(*) AS n_rows FROM orders
UNION ALL SELECT 'tpch/lineitem/batch=20240101T000000Z', 'match', COUNT(*) FROM lineitem
UNION ALL SELECT 'tpch/documents/batch=20240101T000000Z', 'match', COUNT(*) FROM documents""",
    "partition_refresh": """
SELECT o_orderkey, CAST(CASE WHEN strftime(o_orderdate, '%Y-%m') = '1995-03' THEN 2 ELSE 1 END * CAST(o_totalprice AS DECIMAL(12,2))
       AS DECIMAL(12,2)) AS price, strftime(o_orderdate, '%Y-%m') AS month
FROM orders""",
    "default_values": """
SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE o_orderstatus END AS status,
       CASE WHEN o_totalprice < 50000 THEN CAST(0 AS DECIMAL(12,2)) ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS price
FROM orders""",
    "text_formats": """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
       '0x' || hex(CAST(o_orderkey AS VARCHAR)) AS key_hex, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS batch
FROM orders""",
    "star_load_rows": "WITH " + _star_dims() + "SELECT * FROM fact_sales",
    "curate_job": dq.DQ_CTE + """
SELECT COUNT(*) AS extracted,
       COUNT(*) FILTER (WHERE rejection_reason IS NULL) AS accepted,
       COUNT(*) FILTER (WHERE rejection_reason IS NOT NULL) AS rejected,
       ROUND(CAST(COUNT(*) FILTER (WHERE rejection_reason IS NULL) AS DOUBLE) / COUNT(*), 4) AS pass_rate,
       COUNT(*) AS observed_extracted
FROM classified""",
    "star_load": "WITH " + _star_dims() + """
SELECT 'dim_part' AS table_name, COUNT(*) AS row_count FROM dim_part
UNION ALL SELECT 'dim_customer', COUNT(*) FROM dim_customer
UNION ALL SELECT 'dim_nation', COUNT(*) FROM dim_nation
UNION ALL SELECT 'fact_sales', COUNT(*) FROM fact_sales""",
})
