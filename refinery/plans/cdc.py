"""CDC queries on the ``events`` table read as a change log.

Role mapping: key = user_id, lsn = ts, seq = event_id; signup → INSERT,
error → DELETE, every other event → UPDATE; image = (event_type, value).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc
from ..operators.rules import with_row_id
from ..session import scratch_dir
from .common import t
from .registry import attach, query

# The change range and the operation mapping of the log.
LO, HI = "2024-01-10 00:00:00", "2024-01-12 00:00:00"
KEYS, IMAGE = ["user_id"], ["event_type", "value"]


def to_change_log(events, extra=()):
    """events → change log ``(lsn, seq, operation, user_id, event_type, value)``."""
    op = (F.when(F.col("event_type") == "signup", F.lit("INSERT"))
          .when(F.col("event_type") == "error", F.lit("DELETE")).otherwise(F.lit("UPDATE")))
    return events.select(F.col("ts").alias("lsn"), F.col("event_id").alias("seq"), op.alias("operation"),
                         "user_id", "event_type", "value", *extra)


def change_log(spark, sf, row_id: bool = False):
    e = t(spark, sf, "events")
    if row_id:
        return to_change_log(with_row_id(e), ["_rid_file", "_rid_row"])
    return to_change_log(e)


@query("cdc_all")
def cdc_all(spark, sf):
    return cdc.all_changes(change_log(spark, sf), LO, HI, include_hi=False)


@query("cdc_all_update_old")
def cdc_all_update_old(spark, sf):
    return cdc.all_changes_update_old(change_log(spark, sf), KEYS, IMAGE, LO, HI, include_hi=False)


@query("cdc_net")
def cdc_net(spark, sf):
    return cdc.net_changes(change_log(spark, sf), KEYS, IMAGE, LO, HI, include_hi=False)


@query("cdc_apply")
def cdc_apply(spark, sf):
    log = change_log(spark, sf)
    before = cdc.replay(log, KEYS, IMAGE, LO, include_hi=False)    # state at LO
    after = cdc.apply_changes(before, cdc.in_range(log, LO, HI, include_hi=False), KEYS, IMAGE)
    return after.select("user_id", "event_type", "value", F.col("lsn").alias("changed_at"))


@query("cdc_op_counts")
def cdc_op_counts(spark, sf):
    log = change_log(spark, sf)
    return (log.groupBy(F.col("lsn").cast("date").alias("change_date"), "operation")
            .agg(F.count(F.lit(1)).alias("changes")))


@query("cdc_commit_time")
def cdc_commit_time(spark, sf):
    log = change_log(spark, sf).withColumn("txn", F.date_trunc("minute", F.col("lsn")))
    changes = cdc.in_range(log, LO, HI, include_hi=False)
    # transactions are minutes and the range ends on minutes, so its own changes have all their commits
    txn_map = changes.groupBy("txn").agg(F.max("lsn").alias("commit_time"))
    return (cdc.map_commit_time(changes, txn_map, "txn")
            .select("seq", "lsn", "operation", "user_id", "commit_time"))


@query("watermark_gap")
def watermark_gap(spark, sf):
    return cdc.watermark_gap(change_log(spark, sf, row_id=True), KEYS, LO, HI, ["_rid_file", "_rid_row"], include_hi=False)


def coded_log(spark, sf):
    """The events as a change table has them: codes 1 delete, 2 insert, and an update as two
    rows of one (lsn, seq), 3 with the image before it and 4 with the one after."""
    log = change_log(spark, sf)
    code = F.when(F.col("operation") == "INSERT", 2).when(F.col("operation") == "DELETE", 1).otherwise(4)
    row = lambda c, kind, value: F.struct("lsn", "seq", c.alias("operation"), "user_id",
                                          kind.alias("event_type"), value.alias("value"))
    after = row(code, F.col("event_type"), F.col("value"))
    before = row(F.lit(3), F.concat(F.lit("was "), "event_type"), -F.col("value"))
    rows = F.when(F.col("operation") == "UPDATE", F.array(before, after)).otherwise(F.array(after))
    return log.select(F.explode(rows).alias("r")).select("r.*")


@query("cdc_coded_all")
def cdc_coded_all(spark, sf):
    return cdc.all_changes(coded_log(spark, sf), LO, HI)


@query("cdc_coded_update_old")
def cdc_coded_update_old(spark, sf):
    return cdc.all_changes_update_old(coded_log(spark, sf), KEYS, IMAGE, LO, HI)


@query("cdc_coded_net")
def cdc_coded_net(spark, sf):
    return cdc.net_changes(coded_log(spark, sf), KEYS, IMAGE, LO, HI)


@query("cdc_coded_apply")
def cdc_coded_apply(spark, sf):
    log = coded_log(spark, sf)
    state = cdc.apply_changes(cdc.replay(log, KEYS, IMAGE, LO), cdc.in_range(log, LO, HI), KEYS, IMAGE)
    return state.select("user_id", "event_type", "value", F.col("lsn").alias("changed_at"))


@query("incremental_hwm")
def incremental_hwm(spark, sf):
    """Three batch loads by stored high-water mark; the last one finds nothing new."""
    root = scratch_dir(spark, "incremental")
    log = change_log(spark, sf)
    cdc.load_incremental(cdc.in_range(log, None, LO), root)
    cdc.load_incremental(log, root)
    cdc.load_incremental(log, root)
    return cdc.loaded(spark, root).groupBy("load").agg(
        F.count(F.lit(1)).alias("changes"), F.max("lsn").alias("mark"))


@query("cdc_bucketed_apply")
def cdc_bucketed_apply(spark, sf):
    """Three batches of the log, the second one late, applied to a table in buckets; one is delivered twice."""
    root = scratch_dir(spark, "buckets")
    log = change_log(spark, sf)
    batches = {"a": cdc.in_range(log, None, LO, include_hi=False), "c": cdc.in_range(log, HI, None),
               "b": cdc.in_range(log, LO, HI, include_hi=False)}
    for name in ("a", "c", "b", "b"):
        cdc.apply_to_buckets(batches[name], root, KEYS, IMAGE, name, buckets=16)
    schema = log.select(*KEYS, "operation", *IMAGE, "lsn", "seq").schema
    return cdc.bucketed_state(spark, root, schema).select("user_id", "event_type", "value", F.col("lsn").alias("changed_at"))


LOG_SQL = """
log AS (
  SELECT ts AS lsn, event_id AS seq,
         CASE WHEN event_type = 'signup' THEN 'INSERT' WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END
           AS operation,
         user_id, event_type, value
  FROM events)"""
RANGE = "lsn >= TIMESTAMP '2024-01-10 00:00:00' AND lsn < TIMESTAMP '2024-01-12 00:00:00'"
CLOSED = "lsn >= TIMESTAMP '2024-01-10 00:00:00' AND lsn <= TIMESTAMP '2024-01-12 00:00:00'"

attach({
    "cdc_all": f"WITH {LOG_SQL} SELECT * FROM log WHERE {RANGE}",
    "cdc_all_update_old": f"""WITH {LOG_SQL},
prev AS (
  SELECT *, LAG(event_type) OVER w AS prev_event_type, LAG(value) OVER w AS prev_value
  FROM log WHERE lsn < TIMESTAMP '2024-01-12 00:00:00'
  WINDOW w AS (PARTITION BY user_id ORDER BY lsn, seq))
SELECT lsn, seq, user_id, CASE WHEN operation = 'UPDATE' THEN 'UPDATE (after)' ELSE operation END AS operation,
       event_type, value
FROM prev WHERE {RANGE}
UNION ALL
SELECT lsn, seq, user_id, 'UPDATE (before)', prev_event_type, prev_value
FROM prev WHERE {RANGE} AND operation = 'UPDATE'""",
    "cdc_net": f"""WITH {LOG_SQL},
r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn, seq) AS rn_first,
            ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) AS rn_last
  FROM log WHERE {RANGE}),
f AS (SELECT user_id, operation AS first_op FROM r WHERE rn_first = 1),
l AS (SELECT user_id, operation AS last_op, event_type, value, lsn FROM r WHERE rn_last = 1)
SELECT CASE WHEN first_op = 'INSERT' THEN 'INSERT' WHEN last_op = 'DELETE' THEN 'DELETE' ELSE 'UPDATE' END
         AS net_operation,
       l.user_id, l.event_type, l.value, l.lsn AS last_lsn
FROM f JOIN l ON f.user_id = l.user_id
WHERE NOT (first_op = 'INSERT' AND last_op = 'DELETE')""",
    "cdc_apply": f"""WITH {LOG_SQL},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) AS rn
      FROM log WHERE lsn < TIMESTAMP '2024-01-12 00:00:00')
SELECT user_id, event_type, value, lsn AS changed_at FROM r WHERE rn = 1 AND operation <> 'DELETE'""",
    "cdc_bucketed_apply": f"""WITH {LOG_SQL},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) AS rn FROM log)
SELECT user_id, event_type, value, lsn AS changed_at FROM r WHERE rn = 1 AND operation <> 'DELETE'""",
    "cdc_op_counts": f"""WITH {LOG_SQL}
SELECT CAST(lsn AS DATE) AS change_date, operation, COUNT(*) AS changes FROM log GROUP BY 1, 2""",
    "cdc_commit_time": f"""WITH {LOG_SQL},
txn AS (SELECT date_trunc('minute', lsn) AS txn, MAX(lsn) AS commit_time FROM log GROUP BY 1)
SELECT l.seq, l.lsn, l.operation, l.user_id, x.commit_time
FROM log l LEFT JOIN txn x ON x.txn = date_trunc('minute', l.lsn) WHERE {RANGE}""",
    "watermark_gap": f"""WITH {LOG_SQL},
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) AS rn
      FROM log WHERE {RANGE})
SELECT CASE WHEN operation = 'DELETE' THEN 'missed_delete' WHEN rn > 1 THEN 'missed_intermediate'
            ELSE 'captured' END AS gap_kind, COUNT(*) AS changes
FROM r GROUP BY 1""",
    "cdc_coded_all": f"WITH {LOG_SQL} SELECT * FROM log WHERE {CLOSED}",
    "cdc_coded_update_old": f"""WITH {LOG_SQL}
SELECT lsn, seq, user_id, CASE WHEN operation = 'UPDATE' THEN 'UPDATE (after)' ELSE operation END AS operation,
       event_type, value
FROM log WHERE {CLOSED}
UNION ALL
SELECT lsn, seq, user_id, 'UPDATE (before)', 'was ' || event_type, -value
FROM log WHERE {CLOSED} AND operation = 'UPDATE'""",
    "cdc_coded_net": f"""WITH {LOG_SQL},
r AS (
  SELECT user_id, arg_min(operation, (lsn, seq)) AS first_op, arg_max(operation, (lsn, seq)) AS last_op,
         arg_max(event_type, (lsn, seq)) AS event_type, arg_max(value, (lsn, seq)) AS value, MAX(lsn) AS last_lsn
  FROM log WHERE {CLOSED} GROUP BY user_id)
SELECT CASE WHEN first_op = 'INSERT' THEN 'INSERT' WHEN last_op = 'DELETE' THEN 'DELETE' ELSE 'UPDATE' END
         AS net_operation, user_id, event_type, value, last_lsn
FROM r WHERE NOT (first_op = 'INSERT' AND last_op = 'DELETE')""",
    "cdc_coded_apply": f"""WITH {LOG_SQL},
r AS (
  SELECT user_id, arg_max(operation, (lsn, seq)) AS last_op, arg_max(event_type, (lsn, seq)) AS event_type,
         arg_max(value, (lsn, seq)) AS value, MAX(lsn) AS changed_at
  FROM log WHERE lsn <= TIMESTAMP '2024-01-12 00:00:00' GROUP BY user_id)
SELECT user_id, event_type, value, changed_at FROM r WHERE last_op <> 'DELETE'""",
    "incremental_hwm": f"""WITH {LOG_SQL}
SELECT CAST(lsn > TIMESTAMP '2024-01-10 00:00:00' AS INTEGER) AS load, COUNT(*) AS changes, MAX(lsn) AS mark
FROM log GROUP BY 1""",
})
