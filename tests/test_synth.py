"""Generator invariants (reference tables and the source-system rules)."""

from decimal import Decimal

from pyspark.sql import functions as F

from . import synth


def test_reference_tables(spark):
    ref = synth.reference_tables(spark)
    assert (ref.issuers.count(), ref.plans.count(), ref.rates.count(), ref.service_areas.count()) == (4, 8, 40, 16)
    plans = {r.plan_id: r for r in ref.plans.collect()}
    assert "10001TX0010001" in plans and plans["10001TX0010001"].plan_name == "Harbor Point Bronze HMO"
    rates = {(r.plan_id, r.age_band): r.monthly_rate for r in ref.rates.collect()}
    assert rates[("10001TX0010001", "0-20")] == Decimal("247.00")       # 380 × 0.65 × 1.00
    assert rates[("10002FL0010001", "21-34")] == Decimal("439.92")      # 470 × 0.90 × 1.04
    assert rates[("10004NC0020001", "65+")] == Decimal("1425.60")       # 660 × 2.00 × 1.08
    assert sorted(r.rate_id for r in ref.rates.collect()) == list(range(1, 41))
    by_id = {r.rate_id: (r.plan_id, r.age_band, r.monthly_rate) for r in ref.rates.collect()}
    assert by_id[6] == ("10001TX0020001", "0-20", Decimal("305.50"))
    assert by_id[35] == ("10004NC0010001", "65+", Decimal("1015.20"))
    per_plan = ref.service_areas.groupBy("plan_id").agg(F.countDistinct("county_code").alias("n")).collect()
    assert all(r.n == 2 for r in per_plan)


def test_source_invariants(spark):
    ref = synth.reference_tables(spark)
    src = synth.source_tables(spark, ref)
    members = src.members.toPandas()
    enr = src.enrollments.toPandas()
    elig = src.eligibility.toPandas()
    assert len(members) == 2000 and members.member_id.is_unique
    assert len(enr) == 3000 and enr.enrollment_id.is_unique
    assert sorted(enr.enrollment_id) == list(range(900001, 903001))
    eligible = set(elig[elig.eligibility_status == "ELIGIBLE"].member_id)
    assert set(enr.member_id) == eligible                         # only (and all) eligible members enroll
    counts = enr.groupby("member_id").size()
    for mid in counts[counts == 2].index[:50]:
        a, b = enr[enr.member_id == mid].sort_values("effective_date").itertuples()
        assert (a.status, b.status) == ("TERMINATED", "ACTIVE")
        assert (b.effective_date - a.termination_date).days == 1
        assert b.termination_date is None or b.termination_date != b.termination_date
    canc = enr[enr.status == "CANCELLED"]
    assert (canc.termination_date == canc.effective_date).all()
    term = enr[(enr.status == "TERMINATED")]
    assert all((d + __import__("datetime").timedelta(days=1)).day == 1 for d in term.termination_date)
    rates = {(r.plan_id, r.age_band): r.monthly_rate for r in ref.rates.collect()}
    m = enr.merge(members[["member_id", "age_band", "state_code"]], on="member_id")
    assert all(rates[(p, a)] == prem for p, a, prem in zip(m.plan_id, m.age_band, m.monthly_premium))
    assert all(p[5:7] == s for p, s in zip(m.plan_id, m.state_code))   # plans of the member's state


def test_partition_independent(spark):
    ref = synth.reference_tables(spark)
    a = synth.source_tables(spark, ref, members=300, enrollments=400).enrollments
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = synth.source_tables(spark, ref, members=300, enrollments=400).enrollments
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
