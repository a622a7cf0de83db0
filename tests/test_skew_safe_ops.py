"""The skew-safe operators equal their plain-window definitions, with a hot key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from refinery.operators.rules import flag_first, flag_first_once
from refinery.plans import dq
from refinery.operators.sequence import carry
from refinery.operators.star import assign_keys


def _skewed(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 40, n))        # key 0 holds ~40 % of rows
    pdf = pd.DataFrame({"k": key.astype("int64"), "t": rng.permutation(n).astype("int64"),
                        "v": rng.integers(0, 5, n).astype("int64"),
                        "present": rng.random(n) < 0.3})
    pdf.loc[pdf.index[:5], "k"] = None
    return spark.createDataFrame(pdf.astype({"k": "Int64"}))


def test_carry_equals_lag_and_lead(spark):
    df = _skewed(spark)
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("k", "t", F.lag("v").over(w).alias("lag"), F.lead("v").over(w).alias("lead"))
    got = carry(df, ["k"], ["t"], ["v"], prefix="p_", n_chunks=6)
    got = carry(got, ["k"], ["t"], ["v"], forward=False, prefix="n_", n_chunks=5)
    a = ref.join(got, ["k", "t"]).filter(~F.col("lag").eqNullSafe(F.col("p_v"))
                                         | ~F.col("lead").eqNullSafe(F.col("n_v")))
    assert a.count() == 0
    assert got.count() == df.count()


def test_carry_last_present_equals_last_ignore_nulls(spark):
    df = _skewed(spark, seed=11)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    ref = df.select("k", "t", F.last(F.when(F.col("present"), F.col("v")), ignorenulls=True).over(w).alias("r"))
    got = carry(df, ["k"], ["t"], ["v"], present=F.col("present"), prefix="c_", n_chunks=7)
    bad = ref.join(got, ["k", "t"]).filter(~F.col("r").eqNullSafe(F.col("c_v")))
    assert bad.count() == 0


def test_flag_first_equals_row_number(spark):
    df = _skewed(spark, seed=3).withColumn("rid", F.monotonically_increasing_id())
    df = df.withColumn("o", F.col("v")).cache()     # many ties on the order column
    got = flag_first(df, ["k"], ["o"], ["rid"], flag="f")
    firsts = got.filter("f").groupBy("k").count()
    assert firsts.filter("count != 1").count() == 0
    assert firsts.count() == df.select("k").distinct().count()
    w = Window.partitionBy("k").orderBy("o", "rid")
    ref = df.withColumn("rn", F.row_number().over(w)).select("rid", (F.col("rn") == 1).alias("r"))
    assert ref.join(got.select("rid", "f"), "rid").filter(F.col("r") != F.col("f")).count() == 0


def test_assign_keys_dense_in_order(spark):
    df = spark.range(0, 5000, 3).select((F.col("id") * 7 % 5000).alias("nk"))
    keyed = assign_keys(df, ["nk"], "sk", num_partitions=7).toPandas().sort_values("nk")
    assert list(keyed["sk"]) == list(range(1, len(keyed) + 1))


def test_dimension_keys_are_dense_in_natural_order(spark):
    from refinery.operators.star import build_dimension
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    rows = sorted(build_dimension(part, ["p_partkey"], ["p_brand"], "part_key").collect(), key=lambda r: r.part_key)
    assert [r.part_key for r in rows] == list(range(1, part.count() + 1))
    assert [r.p_partkey for r in rows] == sorted(r.p_partkey for r in rows)


@pytest.mark.parametrize("hot", [0, 100, 10**6])
def test_flag_first_once_equals_row_number(spark, hot):
    """Keys with more rows than a task may sort, null keys among them, and those with fewer; the lookup repeats rows."""
    df = _skewed(spark).withColumn("line", F.col("t") % 3).withColumn("rid", F.monotonically_increasing_id())
    names = spark.createDataFrame([(i, f"n{i}") for i in [*range(30), 0, 7, 7]], "id long, name string")
    w = Window.partitionBy("k", "line").orderBy("v", "t", "rid")
    ref = df.withColumn("f", F.row_number().over(w) == 1).join(names, F.col("k") == F.col("id"), "left").select("rid", "name", "f")
    got = flag_first_once(df, ["k", "line"], ["v", "t"], ["rid"], flag="f", by=["k"], hot=hot,
                          then=lambda rows: rows.join(names, F.col("k") == F.col("id"), "left").drop("id"))
    assert sorted(map(str, got.select("rid", "name", "f").collect())) == sorted(map(str, ref.collect()))
    assert got.columns[:-2] == df.columns and set(got.columns[-2:]) == {"name", "f"}


def test_order_lines_are_shuffled_once_to_be_classified(spark):
    """The lookup of the order date and the rank share one exchange; before, the lines went through three."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = dq.classified(spark, "/root/testdata/sf0.001", once=True)
        again = dq.classify_lines(lines.drop("rejection_reason", "_first"))
        plans = [d.filter("rejection_reason is null")._jdf.queryExecution().executedPlan().toString() for d in (lines, again)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].count("Exchange hashpartitioning(l_orderkey") == 1 and not any("__k0" in p for p in plans)
