"""Contracts that green counts do not show: late changes, coded logs, period bounds, lossless
landing, guarded appends, honest star loads, errors that surface."""

import datetime as dt
import os
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from refinery import jobs, session
from refinery.functions.text import Field
from refinery.operators import cdc, history, quality, star
from refinery.operators.rules import flag_first, with_row_id
from refinery.plans import dq
from refinery.session import child_dirs, path_exists, remove_scratch, scratch_dir
from refinery.sources import landing, raw
from refinery.streaming.incremental import foreach_batch_apply, latest_state

from .conftest import SF_SMALL

LOG = "lsn long, seq long, operation string, k long, v string"


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ------------------------------------------------------------ change capture

LATE = [[(10, 1, "INSERT", 1, "new"), (11, 2, "DELETE", 2, "gone"), (12, 1, "UPDATE", 3, "b")],
        [(5, 1, "INSERT", 1, "old"), (4, 1, "INSERT", 2, "ghost"), (12, 0, "UPDATE", 3, "a")],
        [(13, 1, "UPDATE", 1, "newest"), (1, 1, "INSERT", 4, "four")],
        [(2, 1, "DELETE", 4, "four"), (0, 9, "INSERT", 4, "zero")]]


@pytest.mark.parametrize("compact_every", [1, 2, 10])
def test_late_changes_whatever_the_snapshots(spark, compact_every):
    root = scratch_dir(spark, "late")
    for drop in LATE:
        spark.createDataFrame(drop, LOG).coalesce(1).write.mode("append").parquet(f"{root}/src")
        schema = spark.createDataFrame([], LOG).schema
        foreach_batch_apply(spark, f"{root}/src", schema, f"{root}/state", f"{root}/ckpt", ["k"], ["v"], compact_every=compact_every)
    got = rows_of(latest_state(spark, f"{root}/state", ["k"], ["v"]), "k", "v")
    whole = spark.createDataFrame([r for d in LATE for r in d], LOG)
    assert got == rows_of(cdc.replay(whole, ["k"], ["v"], None), "k", "v") == [(1, "newest"), (3, "b")]


def test_a_base_row_newer_than_the_change_stays(spark):
    base = spark.createDataFrame([(1, "base", 10, 5)], "k long, v string, lsn long, seq long")
    log = spark.createDataFrame([(10, 4, "UPDATE", 1, "older"), (9, 9, "DELETE", 1, "older")], LOG)
    assert rows_of(cdc.apply_changes(base, log, ["k"], ["v"]), "k", "v") == [(1, "base")]
    newer = spark.createDataFrame([(10, 6, "DELETE", 1, "x")], LOG)
    assert cdc.apply_changes(base, newer, ["k"], ["v"]).count() == 0
    plain = spark.createDataFrame([(1, "base", 10)], "k long, v string, lsn long")     # no seq: same lsn gives way
    assert rows_of(cdc.apply_changes(plain, log, ["k"], ["v"]), "k", "v") == [(1, "older")]


@pytest.mark.parametrize("form", ["codes", "text codes", "names", "decoded"])
def test_every_form_of_operation_gives_the_same(spark, form):
    names = {2: "INSERT", 3: "UPDATE (before)", 4: "UPDATE (after)", 1: "DELETE"}
    rows = [(1, 1, 2, 1, "A"), (2, 1, 3, 1, "A*"), (2, 1, 4, 1, "B"), (3, 1, 2, 2, "C"), (4, 1, 1, 2, "C"), (5, 1, 4, 3, "E")]
    log = spark.createDataFrame([(a, b, str(o), k, v) for a, b, o, k, v in rows], LOG)
    if form == "codes":
        log = log.withColumn("operation", F.col("operation").cast("int"))
    elif form == "decoded":
        log = log.withColumn("operation", cdc.decode_operation(F.col("operation").cast("int")))
    elif form == "names":
        log = log.withColumn("operation", F.element_at(F.create_map(*[F.lit(x) for k, n in names.items() for x in (
            str(k), n.replace(" (after)", ""))]), F.col("operation")))
    assert rows_of(cdc.net_changes(log, ["k"], ["v"], None, None), "k", "net_operation", "v") == [(1, "INSERT", "B"), (3, "UPDATE", "E")]
    assert rows_of(cdc.replay(log, ["k"], ["v"], None), "k", "v") == [(1, "B"), (3, "E")]
    assert rows_of(cdc.all_changes(log, None, None), "lsn", "v") == [(1, "A"), (2, "B"), (3, "C"), (4, "C"), (5, "E")]
    old = rows_of(cdc.all_changes_update_old(log, ["k"], ["v"], 2, 4), "lsn", "operation", "v")
    assert old == [(2, "UPDATE (after)", "B"), (2, "UPDATE (before)", "A*"), (3, "INSERT", "C"), (4, "DELETE", "C")]


def test_before_image_from_ahead_of_the_range(spark):
    log = spark.createDataFrame([(1, 1, "INSERT", 1, "a"), (2, 1, "UPDATE", 1, "b"), (9, 1, "UPDATE", 1, "c"), (9, 2, "UPDATE", 7, "z")], LOG)
    got = rows_of(cdc.all_changes_update_old(log, ["k"], ["v"], 9, None).fillna("-"), "k", "operation", "v")
    assert got == [(1, "UPDATE (after)", "c"), (1, "UPDATE (before)", "b"), (7, "UPDATE (after)", "z"), (7, "UPDATE (before)", "-")]


def test_ranges_include_both_ends_and_keep_order(spark):
    log = spark.createDataFrame([(i, s, "UPDATE", i, "x") for i in range(5) for s in (2, 1)], LOG)
    assert cdc.in_range(log, 1, 3).count() == 6 and cdc.in_range(log, 1, 3, include_hi=False).count() == 4
    got = [(r.lsn, r.seq) for r in cdc.in_commit_order(cdc.all_changes(log, 1, 4)).collect()]
    assert got == sorted(got)


def test_high_water_mark_is_stored_after_the_sink(spark):
    root = scratch_dir(spark, "hwm")
    log = spark.createDataFrame([(i, 1, "UPDATE", i, "x") for i in range(10)], LOG)
    assert cdc.load_incremental(cdc.in_range(log, None, 3), root) == 4
    # a load that died before its mark: rows are there, the mark is not
    cdc.in_range(log, 4, 6).write.parquet(f"{root}/changes/load=1")
    assert cdc.loaded(spark, root).count() == 4
    assert cdc.load_incremental(log, root) == 6 and cdc.load_incremental(log, root) == 0
    assert rows_of(cdc.loaded(spark, root), "lsn") == [(i,) for i in range(10)]


# -------------------------------------------------------------------- history

def test_delete_closes_the_period(spark):
    day = [dt.datetime(2026, 1, d) for d in range(1, 6)]
    log = spark.createDataFrame([(1, day[0], 1, 2, "P"), (1, day[1], 2, 1, "P"), (1, day[2], 3, 2, "P"), (2, day[0], 4, 2, "Q"),
                                 (2, day[1], 5, 3, "Q"), (2, day[1], 5, 4, "R"), (3, day[3], 6, 1, "x")],
                                "k long, ts timestamp_ntz, seq long, operation int, v string")
    got = rows_of(history.scd2(log, ["k"], ["ts", "seq"], ["v"], op="operation"), "k", "v", "valid_from", "valid_to")
    end = dt.datetime(9999, 12, 31)
    assert got == [(1, "P", day[0], day[1]), (1, "P", day[2], end), (2, "Q", day[0], day[1]), (2, "R", day[1], end)]
    assert history.as_of(spark.createDataFrame(got, "k long, v string, valid_from timestamp_ntz, valid_to timestamp_ntz"), day[1]).count() == 1


def test_as_of_join_reads_the_period_that_as_of_reads(spark):
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
    hist = spark.createDataFrame([(1, "P", t0, t1), (1, "zero", t1, t1), (1, "E", t1, dt.datetime(9999, 12, 31))],
                                 "k long, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    facts = spark.createDataFrame([(1, t0, 1), (1, t1, 2), (1, t1, 2), (1, dt.datetime(2025, 1, 1), 3), (2, t1, 4)], "k long, ts timestamp_ntz, f int")
    assert rows_of(history.as_of_join(facts, hist, ["k"], "ts", ["v"]), "f", "version_v") == [(1, "P"), (2, "E"), (2, "E")]
    for at in (t0, t1):
        assert [r.v for r in history.as_of(hist, at).collect()] == [r.version_v for r in history.as_of_join(
            facts.filter(F.col("ts") == F.lit(at)).limit(1), hist, ["k"], "ts", ["v"]).collect()]
    before = rows_of(history.as_of_join(facts, hist, ["k"], "ts", ["v"], just_before=True), "f", "version_v")
    assert before == [(2, "P"), (2, "P")]


# --------------------------------------------------------------------- sinks

TEXTS = ["plain", "two\nlines", "cr\r\nlf", 'say "hi", ok', "back\\slash \\n \\s \\N", "", None, "  spaces  ", "\\N", "\\", '"', ",", "é漢🙂", "a\\\nb"]


def test_landed_text_comes_back(spark):
    root = scratch_dir(spark, "lossless")
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)], "id int, a string, b string")
    entry = landing.land(df, root, "s", "t", "20260101T000000Z")
    got = raw.read_latest(spark, os.path.join(root, "s", "t"), ["id", "a", "b"])
    assert rows_of(got.withColumn("id", F.col("id").cast("int")).fillna("<null>"), "id", "a", "b") == [
        (i, "<null>" if t is None else t, "<null>" if t is None else t) for i, t in enumerate(TEXTS)]
    manifest = raw.read_manifest(spark, landing.write_manifest(spark, root, "20260101T000000Z", [entry]))
    status = landing.reconcile_manifest(manifest, landing.landed_counts(spark, root, [("s", "t")])).collect()
    assert [(r.manifest_rows, r.landed_rows, r.status) for r in status] == [(len(TEXTS), len(TEXTS), "match")]
    assert raw.manifest_totals(manifest).collect()[0].asDict() == {"run_ts": "20260101T000000Z", "files": 1, "total_rows": len(TEXTS)}
    # one record a line, so the files can be split
    assert spark.read.text(os.path.join(root, "s", "t")).count() == len(TEXTS) + len(
        [f for f in spark.read.format("binaryFile").load(os.path.join(root, "s", "t", "batch=20260101T000000Z")).select("length").collect() if f.length])


def test_files_of_another_writer_are_read_as_they_are(spark):
    path = scratch_dir(spark, "foreign")
    spark.createDataFrame([("C:\\new",), ("",)], "a string").write.option("header", True).option("escape", '"').csv(path)
    assert rows_of(raw.read_raw(spark, path, ["a"]).fillna("-"), "a") == [("-",), ("C:\\new",)]


def test_append_leaves_one_row_a_new_key(spark):
    target = scratch_dir(spark, "append")
    batch = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (2, "c")], "k long, v string")
    assert landing.append_new(batch, target, ["k"]) == 2 and landing.append_new(batch, target, ["k"]) == 0
    assert rows_of(spark.read.parquet(target), "k", "v") == [(1, "a"), (2, "c")]


def test_an_unreadable_target_is_an_error(spark):
    target = scratch_dir(spark, "wrong")
    spark.createDataFrame([("x",)], "other string").write.parquet(target)
    with pytest.raises(AnalysisException):
        landing.append_new(spark.createDataFrame([(1, "a")], "k long, v string"), target, ["k"])
    assert spark.read.parquet(target).count() == 1


def test_a_failing_listing_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        raw.batches(spark, "nosuchfs://x/y")
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        raw.register_zone(spark, "nosuchfs://x/y")
    assert raw.batches(spark, scratch_dir(spark, "none")) == []
    with pytest.raises(FileNotFoundError):
        raw.read_latest(spark, scratch_dir(spark, "none"))


# ----------------------------------------------------------------- star load

def star_case(spark, fact, dim_rows, on_missing="drop"):
    dim = spark.createDataFrame(dim_rows, "k long, name string")
    root = scratch_dir(spark, "star")
    stages = jobs.load_star(spark.createDataFrame(fact, "id long, k long"), [
        jobs.Dimension("d", dim, ["k"], ["name"], "d_key", [("k", "k")])], root, fact_cols=["id", "d_key"], on_missing=on_missing)
    return root, {r.table_name: r.row_count for r in stages.collect()}


def test_two_rows_of_one_natural_key_raise(spark):
    with pytest.raises(quality.ReconciliationError, match="natural key"):
        star_case(spark, [(1, 1)], [(1, "a"), (1, "b")])


def test_dropped_fact_rows_are_reported(spark):
    root, stages = star_case(spark, [(1, 1), (2, 9), (3, None)], [(1, "a"), (1, "a")])
    assert stages == {"d": 1, "fact": 1}
    assert rows_of(spark.read.parquet(f"{root}/fact_unmatched"), "id", "missing_dimension") == [(2, "d"), (3, "d")]


def test_missing_keys_as_unknown_or_failure(spark):
    root, stages = star_case(spark, [(1, 1), (2, 9)], [(1, "a")], "unknown")
    assert stages["fact"] == 2 and rows_of(spark.read.parquet(f"{root}/fact"), "id", "d_key") == [(1, 1), (2, -1)]
    with pytest.raises(quality.ReconciliationError):
        star_case(spark, [(1, 1), (2, 9)], [(1, "a")], "fail")
    with pytest.raises(ValueError):
        star_case(spark, [(1, 1)], [(1, "a")], "ignore")
    dim, fact = spark.createDataFrame([(1, 5)], "k long, d_key long"), spark.createDataFrame([(2,)], "k long")
    with pytest.raises(Exception, match="no match in lookup"):
        star.lookup_keys(fact, [(dim, [("k", "k")], ["d_key"])], "fail").collect()
    with pytest.raises(ValueError):
        star.lookup_keys(fact, [(dim, [("k", "k")], ["d_key"])], "left")


def test_curate_counts_the_source_before_joins(spark):
    rows = dq.classified(spark, SF_SMALL)
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    with pytest.raises(quality.ReconciliationError):
        jobs.curate(rows.unionByName(rows.limit(1)), scratch_dir(spark, "lake"), columns=dq.LINE_COLS, expected_rows=lineitem)


# ------------------------------------------------------------------- helpers

def test_constraint_names_may_hold_quotes(spark):
    df = spark.createDataFrame([(None,)], "a int")
    assert rows_of(quality.validate(df, [quality.not_null("it's \"odd\"", "a")]), "constraint", "violations") == [("it's \"odd\"", 1)]


def test_row_ids_of_text_files_are_carried(spark):
    path = scratch_dir(spark, "csv")
    spark.range(500).selectExpr("cast(id % 7 as string) as k", "cast(id as string) as v").repartition(5).write.option("header", True).csv(path)
    df = with_row_id(spark.read.option("header", True).csv(path))
    assert df.select("_rid_file", "_rid_row").distinct().count() == 500
    firsts = flag_first(df, ["k"], [F.lit(1)], ["_rid_file", "_rid_row"], flag="f").filter("f")
    assert firsts.count() == 7 and rows_of(firsts, "k", "v") == rows_of(firsts, "k", "v")


def test_first_rows_with_null_keys_and_ties(spark):
    rows = [(None, 1, 1), (None, 1, 2), (1, 2, 3), (1, 1, 4), (1, 1, 5), (2, 9, 6)]
    df = spark.createDataFrame(rows, "k int, o int, id int")
    flagged = {r.id: r.f for r in flag_first(df, ["k"], ["o"], ["id"], flag="f").collect()}
    assert [i for i, f in sorted(flagged.items()) if f] == [1, 4, 6]
    scoped = {r.id: r.f for r in flag_first(df, ["k"], ["o"], ["id"], flag="f", scope=F.col("id") != 4).collect()}
    assert [i for i, f in sorted(scoped.items()) if f] == [1, 5, 6]
    last = {r.id: r.f for r in flag_first(df, ["k"], ["o"], ["id"], flag="f", last=True).collect()}
    assert [i for i, f in sorted(last.items()) if f] == [2, 3, 6]


def test_a_cluster_has_to_name_its_shared_folder():
    conf = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))


def test_scratch_folders_can_be_listed_and_removed(spark):
    path = scratch_dir(spark, "gone")
    spark.range(1).write.parquet(f"{path}/a=1")
    spark.range(1).write.parquet(f"{path}/_hidden")
    assert child_dirs(spark, path) == ["a=1"] and path_exists(spark, path)
    assert not path_exists(spark, f"{path}/b")
    assert remove_scratch(spark) and not path_exists(spark, path)


def test_duplicate_rank_sorts_no_whole_table(spark):
    """One wide exchange on the key, hash aggregates over key columns, no sort before the shuffle."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
        plan = flag_first(with_row_id(li), dq.KEY, dq.DUP_ORDER, dq.ROW_ID, flag="f")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Window" not in plan and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    wide = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(wide) <= 3          # keys counted, rows of repeated keys ranked, all rows once


def test_defaults_apply_to_blank_text(spark):
    from refinery.functions.text import standardize
    df = standardize(spark.createDataFrame([("  ",), ("7",), ("x",)], "a string"), [Field("a", "int", default="-1")])
    assert sorted(r.a for r in df.collect()) == [-1, -1, 7]
