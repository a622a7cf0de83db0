"""Bucketed copy-on-write tables, history kept up batch by batch, and in-stream duplicate removal."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from refinery.operators import cdc, history
from refinery.sources import buckets
from refinery.streaming.incremental import land_once

LOG = "lsn long, seq long, operation string, k long, v string"
HISTORY = "k long, v string, valid_from long, valid_to long"
KEYS, IMAGE = ["k"], ["v"]


def made_log(n, keys, seed):
    rnd = random.Random(seed)
    return [(t, t, rnd.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), rnd.choice([*range(keys), 0, 0, 0]), rnd.choice("xyz")) for t in range(n)]


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def state(spark, root, load=None):
    schema = spark.createDataFrame([], LOG).select("k", "operation", "v", "lsn", "seq").schema
    return sorted(map(tuple, cdc.bucketed_state(spark, root, schema, load=load).select("k", "v", "lsn", "seq").collect()))


def replayed(spark, rows):
    return sorted(map(tuple, cdc.replay(spark.createDataFrame(rows, LOG), KEYS, IMAGE, None).select("k", "v", "lsn", "seq").collect()))


def test_apply_rewrites_only_the_buckets_of_the_batch(spark, tmp_path):
    root = str(tmp_path / "state")
    first, change = made_log(400, 60, 1), [(1000, 0, "UPDATE", 7, "new"), (1001, 0, "DELETE", 8, None)]
    cdc.apply_to_buckets(spark.createDataFrame(first, LOG), root, KEYS, IMAGE, "first", buckets=32)
    before = files(root)
    touched = cdc.apply_to_buckets(spark.createDataFrame(change, LOG), root, KEYS, IMAGE, "change", buckets=32)
    wanted = {r[0] for r in spark.createDataFrame([(7,), (8,)], "k long").select(buckets.bucket_of(["k"], 32)).collect()}
    assert set(touched) == wanted and len(touched) <= 2
    fresh = {f for f in files(root) - before if "/rows/" in f}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in fresh} == wanted and before <= files(root)
    assert state(spark, root) == replayed(spark, first + change)
    assert state(spark, root, load=0) == replayed(spark, first)            # the version before stays readable


def test_late_and_repeated_batches(spark, tmp_path):
    root, rows = str(tmp_path / "state"), made_log(300, 20, 2)
    for name, part in (("a", rows[:100]), ("c", rows[200:]), ("b", rows[100:200]), ("b", rows[100:200])):
        cdc.apply_to_buckets(spark.createDataFrame(part, LOG), root, KEYS, IMAGE, name, buckets=8)
    assert state(spark, root) == replayed(spark, rows) and buckets.loads(spark, root) == [0, 1, 2]
    assert cdc.apply_to_buckets(spark.createDataFrame(rows[:5], LOG), root, KEYS, IMAGE, "a") == []
    assert 0 in buckets.drop_unused(spark, root) or buckets.loads(spark, root) == [2]
    assert state(spark, root) == replayed(spark, rows)


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_path):
    root, rows = str(tmp_path / "state"), made_log(200, 20, 3)
    cdc.apply_to_buckets(spark.createDataFrame(rows[:100], LOG), root, KEYS, IMAGE, "a", buckets=8)

    def dies():
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        cdc.apply_to_buckets(spark.createDataFrame(rows[100:], LOG), root, KEYS, IMAGE, "b", before_commit=dies)
    assert state(spark, root) == replayed(spark, rows[:100])
    cdc.apply_to_buckets(spark.createDataFrame(rows[100:], LOG), root, KEYS, IMAGE, "b")
    assert state(spark, root) == replayed(spark, rows)


def test_empty_tables_and_null_keys(spark, tmp_path):
    root = str(tmp_path / "state")
    assert cdc.apply_to_buckets(spark.createDataFrame([], LOG), root, KEYS, IMAGE, "none", buckets=4) == []
    assert state(spark, root) == []
    cdc.apply_to_buckets(spark.createDataFrame([(1, 1, "INSERT", None, "x"), (2, 2, "INSERT", 5, None)], LOG), root, KEYS, IMAGE, "a")
    assert [(r[0], r[1]) for r in cdc.bucketed_state(spark, root, "k long, operation string, v string, lsn long, seq long")
            .select("k", "v").orderBy("lsn").collect()] == [(None, "x"), (5, None)]


@pytest.mark.parametrize("op", [None, "operation"])
def test_history_by_batches_is_that_of_the_whole_log(spark, tmp_path, op):
    """The middle batch comes last: closed periods are split, versions that a late row made equal are merged."""
    rows = made_log(240, 12, 4)
    log = spark.createDataFrame(rows, LOG)
    whole = history.scd2(log, KEYS, ["lsn", "seq"], IMAGE, op=op, open_end=str(2**60))
    root = str(tmp_path / "history")
    parts = [rows[:90], rows[160:], rows[90:160], rows[90:100]]
    for i, part in enumerate(parts):
        history.merge_history(spark.createDataFrame(part, LOG), root, KEYS, ["lsn", "seq"], IMAGE, str(i), op=op, open_end=str(2**60), buckets=8)
    got = history.stored_history(spark, root, HISTORY)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


def test_history_leaves_untouched_buckets_alone(spark, tmp_path):
    root = str(tmp_path / "history")
    history.merge_history(spark.createDataFrame(made_log(200, 40, 5), LOG), root, KEYS, ["lsn", "seq"], IMAGE, "a", open_end=str(2**60), buckets=16)
    before = files(root)
    touched = history.merge_history(spark.createDataFrame([(900, 1, "UPDATE", 3, "q")], LOG), root, KEYS, ["lsn", "seq"], IMAGE, "b", open_end=str(2**60))
    fresh = {f for f in files(root) - before if "/versions/" in f or "/rows/" in f}
    assert len(touched) == 1 and {int(f.split("bucket=")[1].split("/")[0]) for f in fresh if "bucket=" in f} == set(touched)


EVENTS = "id long, ts timestamp_ntz, v string"
DAY = dt.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame([(i, DAY + dt.timedelta(hours=h), f"v{i}") for i, h in rows], EVENTS).coalesce(1)


def test_stream_lands_every_event_once_and_forgets_old_keys(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    schema = events(spark, []).schema
    drops = [[(i, i) for i in range(0, 100)] + [(i, i) for i in range(50, 60)],
             [(i, i) for i in range(90, 400)] + [(395, 395)],
             [(i, i) for i in range(380, 500)] + [(3, 3)]]                 # a repeat from long before the watermark
    said = []
    for drop in drops:
        events(spark, drop).write.mode("append").parquet(src)
        said.append(land_once(spark, src, schema, sink, ckpt, ["id"], "ts", "48 hours"))
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(500))
    assert said[-1]["late_rows"] == 1 and said[-1]["state_rows"] <= 100    # 500 keys seen, two days of them kept
    again = land_once(spark, src, schema, sink, ckpt, ["id"], "ts", "48 hours")
    assert again["late_rows"] == 0 and spark.read.parquet(sink).count() == 500


def test_stream_that_dies_resumes_without_repeats(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    schema = events(spark, []).schema
    for lo in (0, 40, 80):                                                 # three files, a micro-batch each
        events(spark, [(i, i) for i in range(lo, lo + 50)]).write.mode("append").parquet(src)

    def dies(stream):
        return stream.withColumn("v", F.when(F.col("id") == 119, F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("v")))

    with pytest.raises(Exception, match="killed"):
        land_once(spark, src, schema, sink, ckpt, ["id"], "ts", "48 hours", transform=dies, files_per_batch=1)
    land_once(spark, src, schema, sink, ckpt, ["id"], "ts", "48 hours", files_per_batch=1)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(130))
