"""The reference pipeline end to end on Spark, reproducing its published numbers:
generate → CDC demo applied → land 10 datasets with a manifest → curate (3,176 in,
3,101 accepted, 75 rejected, pass rate 0.9764) → star schema (fact = 3,101) →
the analysis SQL in Spark SQL."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from refinery import enrollment, jobs
from refinery.functions.expr import end_of_month
from refinery.operators import cdc
from refinery.operators.measures import measures, top_n, what_if
from refinery.session import scratch_dir
from refinery.sources import landing, raw

from . import synth

FEED_COLS = enrollment.ENR_COLS


def _as_text(df, cols):
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols])


def _feed(spark, plan_ids):
    plans = F.array(*[F.lit(p) for p in plan_ids])

    def rows(start, n, **over):
        base = {"enrollment_id": (F.col("id") + start).cast("string"),
                "member_id": (F.col("id") * 7 % 2000 + 100001).cast("string"),
                "plan_id": F.element_at(plans, (F.col("id") % len(plan_ids) + 1).cast("int")),
                "coverage_year": F.lit("2026"), "effective_date": F.lit("2026-11-01"),
                "termination_date": F.lit(""), "status": F.lit("PENDING"),
                "monthly_premium": F.format_number(F.col("id") * 6.5 + 250, 2)}
        base.update({k: F.lit(v) for k, v in over.items()})
        return spark.range(n).select(*[base[c].alias(c) for c in FEED_COLS])

    bad = [rows(950101, 10, member_id="999999"), rows(950111, 10, plan_id="99999ZZ0010001"),
           rows(950121, 10, monthly_premium="-150.00"), rows(950131, 10, status="ENROLLED"),
           rows(950141, 10, termination_date="2026-10-15"), rows(950151, 15, plan_id=""), rows(950001, 10)]
    out = rows(950001, 100)
    for b in bad:
        out = out.unionByName(b)
    return out


def _cdc_demo(spark, members, enrollments):
    """The five-change demo: two inserts, two updates, one delete."""
    tx_member = (members.filter("state_code = 'TX'").join(enrollments.select("member_id"), "member_id", "left_anti")
                 .agg(F.min("member_id")).collect()[0][0])
    term = enrollments.filter("status = 'ACTIVE'").orderBy("enrollment_id").limit(1).collect()[0]
    t = [dt.datetime(2026, 10, 20, 9, 0, i) for i in range(5)]
    new = dict(member_id=tx_member, plan_id="10001TX0010001", coverage_year=2026,
               effective_date=dt.date(2026, 10, 1), termination_date=None, monthly_premium=Decimal("412.50"))
    rows = [
        (t[0], 1, "INSERT", 999001, "PENDING", new),
        (t[1], 2, "INSERT", 999002, "PENDING", new),
        (t[2], 3, "UPDATE", 999001, "ACTIVE", new),
        (t[3], 4, "UPDATE", term.enrollment_id, "TERMINATED",
         dict(member_id=term.member_id, plan_id=term.plan_id, coverage_year=term.coverage_year,
              effective_date=term.effective_date, termination_date=dt.date(2026, 10, 31),
              monthly_premium=term.monthly_premium)),
        (t[4], 5, "DELETE", 999002, "PENDING", new),
    ]
    schema = ("lsn timestamp_ntz, seq long, operation string, enrollment_id long, member_id long, plan_id string, "
              "coverage_year short, effective_date date, termination_date date, status string, "
              "monthly_premium decimal(10,2)")
    return spark.createDataFrame([(lsn, s, op, eid, r["member_id"], r["plan_id"], r["coverage_year"],
                                   r["effective_date"], r["termination_date"], st, r["monthly_premium"])
                                  for lsn, s, op, eid, st, r in rows], schema)


def test_reference_pipeline_end_to_end(spark):
    ref = synth.reference_tables(spark)
    src = synth.source_tables(spark, ref)
    image = [c for c in FEED_COLS if c != "enrollment_id"]

    # CDC demo → 3,001 system-of-record rows; net changes = 2 rows
    changes = _cdc_demo(spark, src.members, src.enrollments)
    base = src.enrollments.withColumn("lsn", F.lit(dt.datetime(2026, 10, 1)).cast("timestamp_ntz"))
    enrollments = cdc.apply_changes(base.select("enrollment_id", *image, "lsn"), changes, ["enrollment_id"], image)
    assert enrollments.count() == 3001
    net = {(r.enrollment_id, r.net_operation, r.status)
           for r in cdc.net_changes(changes, ["enrollment_id"], image, None, None).collect()}
    assert {(op, st) for _, op, st in net} == {("INSERT", "ACTIVE"), ("UPDATE", "TERMINATED")}
    assert cdc.all_changes_update_old(changes, ["enrollment_id"], image, None, "2027-01-01").count() == 7

    # land 10 datasets + manifest, all counts reconcile
    raw_root, lake = scratch_dir(spark, "raw"), scratch_dir(spark, "lake")
    plan_ids = sorted(r.plan_id for r in ref.plans.collect())
    tables = {
        ("operational", "applications"): src.applications, ("operational", "members"): src.members,
        ("operational", "eligibility"): src.eligibility,
        ("operational", "enrollments"): _as_text(enrollments, FEED_COLS),
        ("operational", "enrollments_cdc"): changes,
        ("planref", "issuers"): ref.issuers, ("planref", "plans"): ref.plans,
        ("planref", "plan_rates"): ref.rates, ("planref", "service_areas"): ref.service_areas,
        ("external", "enrollment_feed"): _feed(spark, plan_ids),
    }
    rec = jobs.land(spark, tables, raw_root, "20261102T060000Z").collect()
    assert len(rec) == 10 and {r.status for r in rec} == {"match"}
    by_table = {r.table: r.landed_rows for r in rec}
    assert (by_table["enrollments"], by_table["enrollment_feed"], by_table["plan_rates"]) == (3001, 175, 40)

    # curate: the published DQ result
    counts = enrollment.curate_enrollments(spark, raw_root, lake, "2026-11-02 06:30:00",
                                           expected_rows=by_table["enrollments"] + by_table["enrollment_feed"])
    assert counts == {"extracted": 3176, "accepted": 3101, "rejected": 75, "pass_rate": 0.9764}
    by_reason = {r.rejection_reason: r.rejected_count
                 for r in spark.read.parquet(os.path.join(lake, "dq_rejections_by_reason")).collect()}
    assert by_reason == {"MISSING_REQUIRED_FIELD": 15, "INVALID_MEMBER_ID": 10, "INVALID_PLAN_ID": 10,
                         "NEGATIVE_PREMIUM": 10, "INVALID_STATUS": 10, "INVALID_DATE_RANGE": 10,
                         "DUPLICATE_ENROLLMENT": 10}
    rejected = spark.read.option("header", True).csv(os.path.join(lake, "rejected", "enrollment"))
    assert rejected.count() == 75
    assert {"rejection_reason", "source_system", "source_file", "ingestion_timestamp"} <= set(rejected.columns)
    assert rejected.filter(F.col("source_file").isNull() | F.col("rejection_reason").isNull()).count() == 0

    # star schema: dims first, then the fact through them
    curated = spark.read.parquet(os.path.join(lake, "curated", "enrollment"))
    plans = spark.read.parquet(os.path.join(lake, "curated", "plans"))
    members = spark.read.parquet(os.path.join(lake, "curated", "members"))
    wh = scratch_dir(spark, "warehouse")
    stages = jobs.load_star(curated.withColumn("enrollment_count", F.lit(1).cast("short")), [
        jobs.Dimension("dim_issuer", plans, ["issuer_id"], ["issuer_name", "issuer_state"], "issuer_key",
                       [("issuer_id", "issuer_id")]),
        jobs.Dimension("dim_plan", plans, ["plan_id"], ["plan_name", "metal_level", "issuer_id"], "plan_key",
                       [("plan_id", "plan_id")]),
        jobs.Dimension("dim_member", members, ["member_id"], ["member_state", "age_band", "household_size"],
                       "member_key", [("member_id", "member_id")]),
    ], wh, "fact_enrollment", fact_cols=["enrollment_id", "member_key", "plan_key", "issuer_key", "coverage_year",
                                         "effective_date", "termination_date", "status", "monthly_premium",
                                         "enrollment_count", "active_indicator", "source_system"])
    assert {r.table_name: r.row_count for r in stages.collect()} == \
        {"dim_issuer": 4, "dim_plan": 8, "dim_member": 2000, "fact_enrollment": 3101}

    # reports over the written tables, from the library's own operators
    fact = spark.read.parquet(os.path.join(wh, "fact_enrollment"))
    by_level = measures(fact.join(spark.read.parquet(os.path.join(wh, "dim_plan")), "plan_key"), ["metal_level"],
                        "enrollment_count", "active_indicator", "monthly_premium").collect()
    assert sum(r.total for r in by_level) == 3101 and {r.metal_level for r in by_level} <= set(synth.BASE_RATE)
    assert spark.read.parquet(os.path.join(lake, "dq_summary")).first().pass_rate == 0.9764
    assert spark.read.parquet(os.path.join(wh, "fact_enrollment_unmatched")).count() == 0
    active = enrollments.filter("status = 'ACTIVE'")
    top = top_n(active, 10, [F.col("monthly_premium").desc(), F.col("enrollment_id")]).collect()
    assert len(top) == 10 and all(a.monthly_premium >= b.monthly_premium for a, b in zip(top, top[1:]))
    edited = what_if(active, F.lit(True), {"status": F.lit("TERMINATED"), "termination_date": end_of_month(F.col("effective_date"))})
    assert edited.count() == active.count() and edited.filter("status = 'ACTIVE' or day(termination_date) < 28").isEmpty()

    # the quarantine keeps what could not be read as a value
    texts = raw.read_raw(spark, os.path.join(lake, "rejected", "enrollment"), landed=True)
    assert {r.raw_monthly_premium for r in texts.filter("rejection_reason = 'NEGATIVE_PREMIUM'").collect()} and \
        all(f"raw_{c}" in texts.columns for c in enrollment.ENR_COLS)
