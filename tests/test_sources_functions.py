"""Sources, sinks and small functions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from refinery.functions.expr import batch_id, hex_text, money_text
from refinery.functions.text import Field, standardize
from refinery.operators.cdc import decode_operation
from refinery.session import scratch_dir
from refinery.sources import landing, raw


def test_typed_csv_failfast(spark):
    root = scratch_dir(spark, "typed")
    spark.createDataFrame([("1", "x"), ("oops", "y")], "id string, v string").write.option("header", True).csv(root)
    with pytest.raises(Exception):
        raw.read_typed_csv(spark, root, "id int, v string").collect()


def test_positional_rename(spark):
    root = scratch_dir(spark, "pos")
    spark.createDataFrame([("R", 3)], "rejection_reason string, count long").write.parquet(root)
    assert raw.read_positional(spark, root, ["rejection_reason", "rejected_count"]).columns == \
        ["rejection_reason", "rejected_count"]


def test_default_value_and_formats(spark):
    df = spark.createDataFrame([(None, "412.5"), ("false", "7")], "flag string, m string")
    out = standardize(df, [Field("flag", "boolean", default="true"), Field("m", "decimal(10,2)")]).collect()
    assert [r.flag for r in out] == [True, False]
    r = spark.range(1).select(
        batch_id(F.lit(dt.datetime(2026, 11, 1, 8, 5, 9))).alias("b"),
        money_text(F.lit(412.5)).alias("m"),
        hex_text(F.unhex(F.lit("0000002A000001F00003"))).alias("h"),
        decode_operation(F.lit(3)).alias("op")).collect()[0]
    assert (r.b, r.m, r.h, r.op) == ("20261101T080509Z", "412.50", "0x0000002A000001F00003", "UPDATE (before)")


def test_manifest_roundtrip_and_mismatch(spark):
    root = scratch_dir(spark, "land")
    df = spark.range(5).select(F.col("id").cast("string").alias("a"))
    entry = landing.land(df, root, "src", "t", "20260101T000000Z")
    assert entry["row_count"] == 5
    mpath = landing.write_manifest(spark, root, "20260101T000000Z", [dict(entry, row_count=6)])
    rec = landing.reconcile_manifest(raw.read_manifest(spark, mpath),
                                     landing.landed_counts(spark, root, [("src", "t")])).collect()
    assert [(r.manifest_rows, r.landed_rows, r.status) for r in rec] == [(6, 5, "mismatch")]


def test_append_guard_idempotent(spark):
    target = scratch_dir(spark, "append")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert landing.append_new(df, target, ["k"]) == 2
    assert landing.append_new(df, target, ["k"]) == 0
    assert spark.read.parquet(target).count() == 2


def test_register_zone(spark):
    root = scratch_dir(spark, "zone")
    spark.range(3).write.parquet(os.path.join(root, "dim_a"))
    spark.range(4).write.parquet(os.path.join(root, "fact_b"))
    assert raw.register_zone(spark, root) == ["dim_a", "fact_b"]
    assert spark.sql("SELECT COUNT(*) AS n FROM fact_b").collect()[0].n == 4


def test_row_id_for_parquet_and_csv(spark):
    from refinery.operators.rules import with_row_id
    root = scratch_dir(spark, "rid")
    spark.range(50).select(F.col("id").cast("string").alias("a")).repartition(3).write.option("header", True) \
        .csv(f"{root}/csv")
    spark.range(50).repartition(3).write.parquet(f"{root}/pq")
    for df in (spark.read.option("header", True).csv(f"{root}/csv"), spark.read.parquet(f"{root}/pq")):
        ids = with_row_id(df).select("_rid_file", "_rid_row").collect()
        assert len(set(map(tuple, ids))) == 50


def test_standardize_with_formats(spark):
    import datetime as dt
    df = spark.createDataFrame([("11/01/2026", "2026-11-01 10:00:00", "01/11/2026 10:00", "bad")],
                               "a string, b string, c string, d string")
    out = standardize(df, [Field("a", "date", date_format="MM/dd/yyyy"), Field("b", "timestamp_ntz"),
                           Field("c", "timestamp_ntz", date_format="dd/MM/yyyy HH:mm"),
                           Field("d", "date", date_format="MM/dd/yyyy")]).collect()[0]
    assert out.a == dt.date(2026, 11, 1)
    assert out.b == out.c == dt.datetime(2026, 11, 1, 10, 0)
    assert out.d is None


def _files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if not f.startswith((".", "_"))}


def test_a_landing_under_way_is_invisible(spark, tmp_path):
    root, run1, run2 = str(tmp_path / "raw"), "20260101T000000Z", "20260102T000000Z"
    df = lambda *ids: spark.createDataFrame([(i,) for i in ids], "a long")
    path = os.path.join(root, "s", "t")
    landing.land_all(spark, {("s", "t"): df(1), ("s", "u"): df(1)}, root, run1)
    landing.land(df(1, 2, 3), root, "s", "t", run2)                       # the first of two tables, then nothing more
    os.makedirs(os.path.join(root, "s", "t", "batch=20260103T000000Z", "_temporary"))
    assert raw.read_latest(spark, path).count() == 1
    landing.land_all(spark, {("s", "t"): df(1, 2, 3), ("s", "u"): df(5)}, root, run2)
    assert raw.read_latest(spark, path).count() == 3


def test_a_killed_run_extracts_the_same_changes_again(spark, tmp_path):
    root, key = str(tmp_path / "raw"), ("s", "ct")
    log = spark.createDataFrame([(i, f"v{i}") for i in range(10)], "lsn long, v string")

    def dies():
        raise RuntimeError("killed")

    landing.land_all(spark, {}, root, "20260101T000000Z", {key: log.filter("lsn < 4")})
    for crash in (dies, lambda: None):
        try:
            landing.land_all(spark, {}, root, "20260102T000000Z", {key: log}, before_commit=crash)
        except RuntimeError:
            assert landing.last_marks(spark, root) == {key: "3"}
    landing.land_all(spark, {}, root, "20260103T000000Z", {key: log})      # nothing new
    assert landing.last_marks(spark, root) == {key: "9"}
    rows = raw.read_raw(spark, os.path.join(root, *key), landed=True, provenance=False)
    assert sorted(int(r.lsn) for r in rows.collect()) == list(range(10))
    assert raw.read_latest(spark, os.path.join(root, *key)).count() == 0


def test_a_swapped_value_is_found_in_its_file(spark, tmp_path):
    root, run = str(tmp_path / "raw"), "20260101T000000Z"
    df = spark.createDataFrame([(i, f"name {i}", None if i % 3 else "") for i in range(40)], "a long, b string, c string").repartition(4)
    landing.land_all(spark, {("s", "t"): df}, root, run)
    check = lambda: {r.file: r.status for r in landing.reconcile_files(spark, root, run, [("s", "t")]).collect()}
    assert set(check().values()) == {"match"} and len(check()) > 1
    names = sorted(check())
    changed, gone = (os.path.join(root, "s", "t", f"batch={run}", n) for n in names[:2])
    with open(changed) as f:
        text = f.read()
    lines = text.splitlines()
    one, two = lines[1].split(","), lines[2].split(",")
    one[1], two[1] = two[1], one[1]                                        # same rows, same values, two of them swapped
    with open(changed, "w") as f:
        f.write("\n".join([lines[0], ",".join(one), ",".join(two), *lines[3:]]) + "\n")
    os.rename(gone, gone.replace("part-", "part-9"))
    crc = os.path.join(os.path.dirname(changed), f".{names[0]}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    status = check()
    assert status[names[0]] == "mismatch" and status[names[1]] == "missing" and "unlisted" in status.values()
    assert all(v == "match" for n, v in status.items() if n in names[2:])


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, f"m{i % 3}") for i in range(30)], "a long, m string")
    landing.overwrite_partitions(df, path, ["m"])
    before = _files(path)
    landing.overwrite_partitions(df.filter("m = 'm1'").withColumn("a", F.col("a") + 100), path, ["m"])
    after = _files(path)
    assert {f: t for f, t in before.items() if "m=m1" not in f} == {f: t for f, t in after.items() if "m=m1" not in f}
    assert sorted(r.a for r in spark.read.parquet(path).collect()) == sorted(i + 100 * (i % 3 == 1) for i in range(30))
