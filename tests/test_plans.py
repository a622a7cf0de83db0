"""Plan-shape checks: the physical operators the design relies on."""

from refinery import plans

from .conftest import SF_SMALL

plans.load_all()


def _plan(spark, name):
    df = plans.QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_reference_checks_join_distinct_parent_keys(spark):
    p = _plan(spark, "dq_summary")
    assert "LeftOuter" in p and "ExistenceJoin" not in p          # AQE can split a hot child key
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_top_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "q1_top_orders")


def test_anti_join(spark):
    assert "LeftAnti" in _plan(spark, "q2_no_activity")


def test_pushdown_reaches_scan(spark):
    p = _plan(spark, "q4_tiers")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p


def _final(spark, name):
    df = plans.QUERIES[name](spark, SF_SMALL)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_duplicate_rank_has_no_window(spark):
    p = _final(spark, "dq_summary")
    assert "Window" not in p            # the rank is an aggregate + row-id join, not a per-key window


def test_sequences_never_gather_into_one_task(spark):
    for name in ("scd2_history", "as_of_join", "cdc_all_update_old"):
        p = _final(spark, name)
        assert "SinglePartition" not in p, name
        assert "Window" in p and "__chunk" in p, name   # windows run inside (chunk, key) groups


def test_anti_join_side_is_pre_aggregated(spark):
    p = _final(spark, "q2_no_activity")
    assert "HashAggregate(keys=[user_id" in p


def test_operations_are_normalised_once(spark):
    """Nested CDC operators keep a small plan: the mapping is one look-up, never written out again and again."""
    from pyspark.sql import functions as F

    from refinery.operators import cdc
    log = spark.range(10).select(F.col("id").alias("lsn"), F.col("id").alias("seq"), F.lit("update").alias("operation"),
                                 (F.col("id") % 3).alias("k"), F.lit("x").alias("v"))
    state = cdc.last_state(log, ["k"], ["v"])
    for _ in range(3):
        state = cdc.fold(state, log, ["k"], ["v"])
    assert len(state._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    codes = spark.createDataFrame([(1,), (2,), (3,), (4,)], "operation int")
    assert [r[0] for r in cdc.normalise(codes).collect()] == ["DELETE", "INSERT", "UPDATE (before)", "UPDATE"]
    names = spark.createDataFrame([(" insert",), ("4 ",), ("Update (After)",), ("UPDATE (before)",), ("merge",), (None,)], "operation string")
    twice = cdc.normalise(cdc.normalise(names))
    assert [r[0] for r in twice.collect()] == ["INSERT", "UPDATE", "UPDATE", "UPDATE (before)", "MERGE", None]


def test_key_rules_share_one_scan(spark, tmp_path):
    from refinery.operators import quality
    path = str(tmp_path / "t")
    rows = [(1, "a", 1.5), (1, "b", None), (2, "b", None), (3, None, 2.5), (None, None, 2.5), (3, None, 0.0)]
    spark.createDataFrame(rows, "a long, b string, c double").write.parquet(path)
    rules = [quality.primary_key("pk", "a"), quality.unique("ub", "b"), quality.unique("uab", "a", "b"), quality.primary_key("pab", "a", "b"),
             quality.unique("uc", "c")]
    report = quality.validate(spark.read.parquet(path), rules)
    got = {r["constraint"]: r["violations"] for r in report.collect()}
    assert got == {"pk": 5, "ub": 2, "uab": 0, "pab": 3, "uc": 2}
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("FileScan") == 1
