"""The reference's golden DQ scenario rebuilt on our own fixture:
3,001 system-of-record rows + a partner feed of 100 valid and 75 faulty rows
→ 3,101 accepted, 75 rejected, pass rate 0.9764, and the per-reason table."""

from pyspark.sql import functions as F

from refinery import curation, enrollment
from refinery.operators import quality
from refinery.session import scratch_dir
from refinery.sources import landing

ENR_COLS = enrollment.ENR_COLS


def _fixture(spark):
    members = spark.range(100001, 102001).select(F.col("id").alias("member_id"))
    plans = spark.createDataFrame([(p,) for p in ["10001TX0010001", "10001TX0020001", "10002FL0010001"]],
                                  "plan_id string")
    sor = spark.range(3001).select(
        (F.col("id") + 900001).cast("string").alias("enrollment_id"),
        (F.col("id") % 2000 + 100001).cast("string").alias("member_id"),
        F.element_at(F.array(*[F.lit(p) for p in ["10001TX0010001", "10001TX0020001", "10002FL0010001"]]),
                     (F.col("id") % 3 + 1).cast("int")).alias("plan_id"),
        F.lit("2026").alias("coverage_year"), F.lit("2026-01-01").alias("effective_date"),
        F.lit(None).cast("string").alias("termination_date"), F.lit("ACTIVE").alias("status"),
        F.lit("412.50").alias("monthly_premium"))

    def feed(start, n, **over):
        base = {"enrollment_id": (F.col("id") + start).cast("string"),
                "member_id": (F.col("id") % 2000 + 100001).cast("string"),
                "plan_id": F.lit("10001TX0010001"), "coverage_year": F.lit("2026"),
                "effective_date": F.lit("2026-11-01"), "termination_date": F.lit(""),
                "status": F.lit("PENDING"), "monthly_premium": F.lit("300.00")}
        base.update({k: F.lit(v) for k, v in over.items()})
        return spark.range(n).select(*[base[c].alias(c) for c in ENR_COLS])

    valid = feed(950001, 100)
    bad = (feed(950101, 10, member_id="999999").unionByName(feed(950111, 10, plan_id="99999ZZ0010001"))
           .unionByName(feed(950121, 10, monthly_premium="-150.00"))
           .unionByName(feed(950131, 10, status="ENROLLED"))
           .unionByName(feed(950141, 10, termination_date="2026-10-15"))
           .unionByName(feed(950151, 15, plan_id=""))
           .unionByName(feed(950001, 10)))
    return members, plans, sor, valid.unionByName(bad)


def test_golden_scenario(spark):
    members, plans, sor, feed = _fixture(spark)
    root = scratch_dir(spark, "golden")
    landing.land(sor, root, "operational", "enrollments", "20261101T000000Z")
    landing.land(feed, root, "external", "enrollment_feed", "20261101T000000Z")
    incoming = curation.incoming(spark, root, {"operational": "operational/enrollments",
                                               "external_feed": "external/enrollment_feed"}, enrollment.SPEC)
    cls = curation.classified(incoming, {"members": members, "plans": plans}, enrollment.SPEC)
    s = quality.summary(cls).collect()[0]
    assert (s.extracted, s.accepted, s.rejected, s.pass_rate) == (3176, 3101, 75, 0.9764)
    by = {r.rejection_reason: r.rejected_count for r in quality.by_reason(cls).collect()}
    # The published counts per rule.
    assert by == {"MISSING_REQUIRED_FIELD": 15, "INVALID_MEMBER_ID": 10, "INVALID_PLAN_ID": 10,
                  "NEGATIVE_PREMIUM": 10, "INVALID_STATUS": 10, "INVALID_DATE_RANGE": 10,
                  "DUPLICATE_ENROLLMENT": 10}
    # reconcile raises on a mismatch and passes here
    assert quality.reconcile(s.asDict())["pass_rate"] == 0.9764


def test_orphan_line_is_rejected_not_dropped(spark):
    """A line whose order does not exist stays in the counts (MISSING_REQUIRED_FIELD)."""
    from refinery.plans import dq
    from .conftest import SF_SMALL
    sf = scratch_dir(spark, "sf_orphan")
    for name in ("orders", "supplier", "part"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    orphan = li.limit(1).withColumn("l_orderkey", F.lit(-5).cast("bigint")).withColumn("l_quantity", F.lit(7.0))
    li.unionByName(orphan).write.parquet(f"{sf}/lineitem.parquet")
    cls = dq.classified(spark, sf)
    s = quality.summary(cls).collect()[0]
    assert s.extracted == li.count() + 1
    assert [r.rejection_reason for r in cls.filter("l_orderkey = -5").collect()] == ["MISSING_REQUIRED_FIELD"]


def test_accepted_union_rejected_is_the_input(spark):
    """Every incoming row lands in exactly one zone; each rejected row carries one reason."""
    from refinery.plans import dq
    from .conftest import SF_SMALL
    cls = dq.classified(spark, SF_SMALL)
    acc, rej = quality.split(cls)
    ids = ["_rid_file", "_rid_row"]
    both = acc.select(*ids).unionByName(rej.select(*ids))
    src = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert both.count() == src.count() == both.distinct().count()
    assert rej.filter(F.col("rejection_reason").isNull()).count() == 0
