"""One test per decided hazard."""

import os

import pytest
from pyspark.sql import functions as F

from refinery.functions.expr import bucketize, end_of_month, pass_rate
from refinery.functions.text import Field, standardize
from refinery.operators import quality
from refinery.operators.measures import prioritized_union, top_n
from refinery.operators.rules import Rule, classify, flag_first, reason
from refinery.operators.star import build_dimension, lookup_keys, natural_key_conflicts
from refinery.session import scratch_dir
from refinery.sources import landing, raw


def _std(spark, vals, dtype):
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    return [r.x for r in standardize(df, [Field("x", dtype)]).collect()]


def test_malformed_text_becomes_null(spark):
    assert _std(spark, ["abc", "12.7", "1e3", " 12 ", "", None], "bigint") == [None, None, None, 12, None, None]
    assert [str(x) if x is not None else None for x in
            _std(spark, ["2026-11", "11/01/2026", "2026-11-01"], "date")] == ["2026-11-01", None, "2026-11-01"]
    d = _std(spark, ["412.555", "123456789.00", "-0.001"], "decimal(10,2)")
    assert [str(x) if x is not None else None for x in d] == ["412.56", None, "0.00"]


def test_negative_premium_after_rounding_passes(spark):
    df = standardize(spark.createDataFrame([("-0.001",)], "p string"), [Field("p", "decimal(10,2)")])
    assert classify(df, [Rule("NEG", F.col("p") < 0)]).collect()[0].rejection_reason is None


def test_rule_order_and_null_fallthrough(spark):
    df = spark.createDataFrame([(None, 5), (1, -1), (2, None)], "a int, b int")
    rules = [Rule("A_NULL", F.col("a").isNull()), Rule("B_NEG", F.col("b") < 0)]
    assert [r.rejection_reason for r in classify(df, rules).orderBy(F.col("a").asc_nulls_first()).collect()] == \
        ["A_NULL", "B_NEG", None]


def test_reordered_header_fails(spark):
    root = scratch_dir(spark, "hdr")
    spark.createDataFrame([("1", "x")], "b string, a string").write.option("header", True).csv(root)
    with pytest.raises(Exception):
        raw.read_raw(spark, root, ["a", "b"]).collect()


def test_empty_newest_batch_is_empty(spark):
    root = scratch_dir(spark, "latest")
    landing.land(spark.createDataFrame([("1",)], "a string"), root, "s", "t", "20260101T000000Z")
    newest = os.path.join(root, "s", "t", "batch=20260102T000000Z")
    os.makedirs(newest)
    with open(os.path.join(newest, "part-0.csv"), "w") as f:
        f.write("a\n")
    assert raw.read_latest(spark, os.path.join(root, "s", "t"), ["a"]).count() == 0


def test_invalid_first_copy_scope(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 10)], "k int, o int, v int").withColumn("rid", F.col("o"))
    pre = [Rule("MISSING", F.col("v").isNull())]
    all_scope = flag_first(df, ["k"], ["o"], ["rid"], flag="f")
    valid_scope = flag_first(df, ["k"], ["o"], ["rid"], flag="f", scope=reason(pre).isNull())
    dup = Rule("DUP", ~F.col("f"))
    a = {r.o: r.rejection_reason for r in classify(all_scope, pre + [dup]).collect()}
    v = {r.o: r.rejection_reason for r in classify(valid_scope, pre + [dup]).collect()}
    assert a == {1: "MISSING", 2: "DUP"}          # reference behaviour
    assert v == {1: "MISSING", 2: None}


def test_explicit_source_priority(spark):
    a = spark.createDataFrame([(1, "feed")], "k int, v string").withColumn("rid", F.lit(0))
    b = spark.createDataFrame([(1, "sor")], "k int, v string").withColumn("rid", F.lit(0))
    out = prioritized_union({"external_feed": a, "operational": b}, ["k"], ["operational", "external_feed"], ["rid"])
    assert [r.v for r in out.collect()] == ["sor"]


def test_empty_input_pass_rate_is_null(spark):
    df = spark.createDataFrame([], "rejection_reason string")
    assert quality.summary(df).collect()[0].pass_rate is None
    assert spark.range(1).select(pass_rate(F.lit(0), F.lit(0))).collect()[0][0] is None


def test_constraints_null_semantics(spark):
    child = spark.createDataFrame([(1, None, 5), (2, 9, -1), (None, 1, None), (2, 1, 3)], "id int, fk int, x int")
    parent = spark.createDataFrame([(1,)], "pk int")
    rep = {r.constraint: r.violations for r in quality.validate(child, [
        quality.primary_key("pk", "id"), quality.unique("uq", "id"),
        quality.foreign_key("fk", ["fk"], parent, ["pk"]), quality.check("x_ge_0", F.col("x") >= 0),
        quality.not_null("x_nn", "x"),
    ]).collect()}
    assert rep == {"pk": 3, "uq": 2, "fk": 1, "x_ge_0": 1, "x_nn": 1}


def test_unknown_issuer_and_conflicting_names(spark):
    issuers = spark.createDataFrame([("10001", "Harbor"), ("10001", "Harbor Pt"), ("10002", "Cedar")],
                                    "issuer_id string, issuer_name string")
    dim = build_dimension(issuers, ["issuer_id"], ["issuer_name"], "issuer_key")
    assert natural_key_conflicts(dim, ["issuer_id"]).count() == 1
    fact = spark.createDataFrame([("10003",), ("10002",)], "issuer_id string")
    ok = dim.filter("issuer_id = '10002'")
    assert lookup_keys(fact, [(ok, [("issuer_id", "issuer_id")], ["issuer_key"])]).count() == 1
    unk = lookup_keys(fact, [(ok, [("issuer_id", "issuer_id")], ["issuer_key"])], on_missing="unknown")
    assert sorted(r.issuer_key for r in unk.collect()) == [-1, 3]     # 10002 sorts after both 10001 rows


def test_top_n_ties_total_order(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 9.0)], "id int, v double")
    assert [r.id for r in top_n(df, 2, [F.col("v").desc(), F.col("id")]).collect()] == [1, 2]


def test_bucketize_and_eomonth(spark):
    df = spark.createDataFrame([(399.99,), (400.0,), (700.0,)], "p double")
    labels = [r.t for r in df.select(bucketize("p", [400, 700], ["lt400", "400-699", "700+"]).alias("t")).collect()]
    assert labels == ["lt400", "400-699", "700+"]
    d = spark.createDataFrame([("2026-12-31",)], "d string").select(end_of_month(F.to_date("d"), 2).alias("e"))
    assert str(d.collect()[0].e) == "2027-02-28"


def test_duplicate_lookup_key_detected(spark):
    plans = spark.createDataFrame([("P1",), ("P1",), ("P2",)], "plan_id string")
    assert [r.plan_id for r in quality.duplicate_keys(plans, ["plan_id"]).collect()] == ["P1"]


def test_unparseable_value_rule(spark):
    from refinery.functions.text import unparseable
    spec = [Field("n", "bigint"), Field("d", "date")]
    df = standardize(spark.createDataFrame([("12", "2026-01-01"), ("abc", ""), ("7", "11/01/2026")],
                                           "n string, d string"), spec, keep_raw=True)
    got = [r.rejection_reason for r in classify(df, [Rule("UNPARSEABLE_VALUE", unparseable(spec))]).collect()]
    assert got == [None, "UNPARSEABLE_VALUE", "UNPARSEABLE_VALUE"]


def test_stable_surrogate_keys_across_loads(spark):
    from refinery.operators.star import extend_key_map
    first = extend_key_map(spark.createDataFrame([("b",), ("a",)], "nk string"), ["nk"], "sk")
    assert sorted(map(tuple, first.collect())) == [("a", 1), ("b", 2)]
    second = extend_key_map(spark.createDataFrame([("c",), ("a",), ("aa",)], "nk string"), ["nk"], "sk", first)
    assert sorted(map(tuple, second.collect())) == [("a", 1), ("aa", 3), ("b", 2), ("c", 4)]


def test_by_reason_keeps_unlisted_reasons(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "rejection_reason string")
    got = {r.rejection_reason: r.rejected_count for r in quality.by_reason(df, reasons=["A", "C"]).collect()}
    assert got == {"A": 1, "B": 1, "C": 0}
