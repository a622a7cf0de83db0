"""CDC demo (5 changes → all 5, all-with-old 7, net 2), apply = replay, temporal as-of."""

import datetime as dt

from pyspark.sql import functions as F

from refinery.operators import cdc, history
from refinery.plans import cdc as cdc_plans

from .conftest import SF_SMALL

LOG_SCHEMA = "lsn timestamp_ntz, seq long, operation string, enrollment_id long, status string, premium double"


def _demo(spark):
    t = [dt.datetime(2026, 10, 1, 0, 0, i) for i in range(5)]
    return spark.createDataFrame([
        (t[0], 1, "INSERT", 999001, "PENDING", 412.5),
        (t[1], 2, "INSERT", 999002, "PENDING", 412.5),
        (t[2], 3, "UPDATE", 999001, "ACTIVE", 412.5),
        (t[3], 4, "UPDATE", 900005, "TERMINATED", 380.0),
        (t[4], 5, "DELETE", 999002, "PENDING", 412.5),
    ], LOG_SCHEMA)


def test_demo_counts(spark):
    log = _demo(spark)
    keys, image = ["enrollment_id"], ["status", "premium"]
    assert cdc.all_changes(log, None, None).count() == 5
    old = cdc.all_changes_update_old(log, keys, image, None, "2027-01-01")
    assert old.count() == 7
    befores = {r.enrollment_id: r.status for r in old.filter("operation = 'UPDATE (before)'").collect()}
    assert befores == {999001: "PENDING", 900005: None}
    net = {(r.enrollment_id, r.net_operation, r.status)
           for r in cdc.net_changes(log, keys, image, None, None).collect()}
    assert net == {(999001, "INSERT", "ACTIVE"), (900005, "UPDATE", "TERMINATED")}


def test_net_algebra_all_pairs(spark):
    ts = [dt.datetime(2024, 1, 1, 0, 0, i) for i in range(2)]
    rows, expect = [], {}
    ops = ["INSERT", "UPDATE", "DELETE"]
    k = 0
    for a in ops:
        for b in ops:
            k += 1
            rows += [(ts[0], 2 * k, a, k, "x", 1.0), (ts[1], 2 * k + 1, b, k, "y", 2.0)]
            if a == "INSERT" and b == "DELETE":
                continue
            expect[k] = "INSERT" if a == "INSERT" else ("DELETE" if b == "DELETE" else "UPDATE")
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    got = {r.enrollment_id: r.net_operation
           for r in cdc.net_changes(log, ["enrollment_id"], ["status"], None, None).collect()}
    assert got == expect


def test_apply_equals_replay(spark):
    log = cdc_plans.change_log(spark, SF_SMALL)
    keys, image = ["user_id"], ["event_type", "value"]
    lo, hi = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
    stepwise = cdc.apply_changes(cdc.replay(log, keys, image, lo), cdc.in_range(log, lo, hi), keys, image)
    direct = cdc.replay(log, keys, image, hi)
    assert sorted(map(tuple, stepwise.collect())) == sorted(map(tuple, direct.select(*stepwise.columns).collect()))


def test_incremental_high_water_mark(spark):
    log = _demo(spark)
    hwm = log.filter("seq <= 2").agg(F.max("lsn")).collect()[0][0]
    assert [r.seq for r in cdc.incremental(log, hwm).orderBy("seq").collect()] == [3, 4, 5]


def test_temporal_as_of(spark):
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 3, 1)
    log = spark.createDataFrame([(1, t0, 1, "PENDING"), (1, t1, 2, "ELIGIBLE")],
                                "eligibility_id long, ts timestamp_ntz, seq long, status string")
    h = history.scd2(log, ["eligibility_id"], ["ts", "seq"], ["status"])
    rows = {r.status: (r.valid_from, r.valid_to) for r in h.collect()}
    assert rows["PENDING"] == (t0, t1)
    assert rows["ELIGIBLE"][1] == dt.datetime(9999, 12, 31)
    assert [r.status for r in history.as_of(h, "2026-02-01 00:00:00").collect()] == ["PENDING"]
    assert [r.status for r in history.as_of(h, "2026-03-01 00:00:00").collect()] == ["ELIGIBLE"]


def test_scd2_periods_gap_free(spark):
    from itertools import groupby

    from refinery.plans.history import user_history
    rows = sorted(user_history(spark, SF_SMALL).collect(), key=lambda r: (r.user_id, r.valid_from))
    for _, g in groupby(rows, key=lambda r: r.user_id):
        g = list(g)
        assert all(a.valid_to == b.valid_from for a, b in zip(g, g[1:]))
        assert all(a.event_type != b.event_type for a, b in zip(g, g[1:]))


def test_net_apply_equals_last_op_apply_on_consistent_log(spark):
    log = _demo(spark)
    keys, image = ["enrollment_id"], ["status", "premium"]
    base = spark.createDataFrame([(900005, "ACTIVE", 380.0, dt.datetime(2026, 1, 1)),
                                  (900006, "ACTIVE", 410.0, dt.datetime(2026, 1, 1))],
                                 "enrollment_id long, status string, premium double, lsn timestamp_ntz")
    by_last_op = cdc.apply_changes(base, log, keys, image)
    net = cdc.net_changes(log, keys, image, None, None)
    upserts = net.filter("net_operation != 'DELETE'").select(*keys, *image, F.col("last_lsn").alias("lsn"))
    by_net = base.join(net.select(*keys), keys, "left_anti").unionByName(upserts)
    assert sorted(map(tuple, by_last_op.collect())) == sorted(map(tuple, by_net.select(*by_last_op.columns).collect()))
