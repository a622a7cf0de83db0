"""Hot-key variants: the same operators on tables Spark derives from the given
ones so that ONE key holds about a third of all rows (every row is processed;
the remapping only concentrates keys). Results must equal the plain-window SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc, history
from ..operators.rules import flag_first
from ..session import materialize
from . import dq
from .common import t
from .registry import attach, query

# Cut-offs that send about a third of the rows to key 0.
HOT_EVENTS_BEFORE = "2024-01-11 00:00:00"
HOT_LINES_BEFORE = "1997-05-01 00:00:00"


def hot_events(spark, sf):
    e = t(spark, sf, "events")
    hot = F.col("ts") < F.lit(HOT_EVENTS_BEFORE).cast("timestamp_ntz")
    return e.withColumn("user_id", F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("user_id")))


@query("hot_key_history")
def hot_key_history(spark, sf):
    """SCD2 versions when one user holds a third of the events."""
    return history.scd2(hot_events(spark, sf), ["user_id"], ["ts", "event_id"], ["event_type"])


@query("hot_key_dedupe")
def hot_key_dedupe(spark, sf):
    """First line per (order, line number) when one order key holds a third of the lines."""
    li = t(spark, sf, "lineitem", row_id=True)
    hot = F.col("l_shipdate") < F.lit(HOT_LINES_BEFORE).cast("timestamp_ntz")
    li = li.withColumn("l_orderkey", F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("l_orderkey")))
    firsts = flag_first(li, dq.KEY, dq.DUP_ORDER, dq.ROW_ID, flag="_first").filter("_first")
    return firsts.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


@query("hot_key_as_of_join")
def hot_key_as_of_join(spark, sf):
    """Each purchase with the version in force at its time, one user holding a third of the events."""
    ev = hot_events(spark, sf)
    purchases = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    hist = materialize(history.scd2(ev, ["user_id"], ["ts", "event_id"], ["event_type"]), "history")
    return history.as_of_join(purchases, hist, ["user_id"], "ts", ["event_type"])


@query("hot_key_net_changes")
def hot_key_net_changes(spark, sf):
    """Net change per user over the whole log, one user holding a third of the changes."""
    from .cdc import IMAGE, KEYS, to_change_log
    return cdc.net_changes(to_change_log(hot_events(spark, sf)), KEYS, IMAGE, None, None)


_HOT_HIST = """
e AS (
  SELECT event_id, ts, event_type, value,
         CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN CAST(0 AS BIGINT) ELSE user_id END AS user_id
  FROM events),
s AS (
  SELECT user_id, ts, event_id, event_type,
         LAG(event_type) OVER w AS prev_type, LAG(ts) OVER w AS prev_ts
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
v AS (SELECT user_id, event_type, ts, event_id FROM s
      WHERE prev_ts IS NULL OR prev_type IS DISTINCT FROM event_type),
hist AS (
  SELECT user_id, event_type, ts AS valid_from,
         COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                  TIMESTAMP '9999-12-31 00:00:00') AS valid_to
  FROM v)"""

attach({
    "hot_key_as_of_join": "WITH " + _HOT_HIST + """
SELECT p.event_id, p.user_id, p.ts, p.value, h.event_type AS version_event_type,
       h.valid_from AS version_valid_from, h.valid_to AS version_valid_to
FROM e p JOIN hist h ON h.user_id = p.user_id AND h.valid_from <= p.ts AND p.ts < h.valid_to
WHERE p.event_type = 'purchase'""",
    "hot_key_net_changes": "WITH " + _HOT_HIST.split("s AS (")[0].rstrip().rstrip(",") + """,
log AS (
  SELECT ts AS lsn, event_id AS seq,
         CASE WHEN event_type = 'signup' THEN 'INSERT' WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END
           AS operation,
         user_id, event_type, value
  FROM e),
r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn, seq) AS rn_first,
            ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY lsn DESC, seq DESC) AS rn_last
  FROM log),
f AS (SELECT user_id, operation AS first_op FROM r WHERE rn_first = 1),
l AS (SELECT user_id, operation AS last_op, event_type, value, lsn FROM r WHERE rn_last = 1)
SELECT CASE WHEN first_op = 'INSERT' THEN 'INSERT' WHEN last_op = 'DELETE' THEN 'DELETE' ELSE 'UPDATE' END
         AS net_operation,
       l.user_id, l.event_type, l.value, l.lsn AS last_lsn
FROM f JOIN l ON f.user_id = l.user_id
WHERE NOT (first_op = 'INSERT' AND last_op = 'DELETE')""",
    "hot_key_history": """
WITH e AS (
  SELECT event_id, ts, event_type,
         CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN CAST(0 AS BIGINT) ELSE user_id END AS user_id
  FROM events),
s AS (
  SELECT user_id, ts, event_id, event_type,
         LAG(event_type) OVER w AS prev_type, LAG(ts) OVER w AS prev_ts
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
v AS (SELECT user_id, event_type, ts, event_id FROM s
      WHERE prev_ts IS NULL OR prev_type IS DISTINCT FROM event_type)
SELECT user_id, event_type, ts AS valid_from,
       COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                TIMESTAMP '9999-12-31 00:00:00') AS valid_to
FROM v""",
    "hot_key_dedupe": """
WITH l AS (
  SELECT CASE WHEN l_shipdate < TIMESTAMP '1997-05-01 00:00:00' THEN CAST(0 AS BIGINT) ELSE l_orderkey END
           AS l_orderkey,
         l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
         l_returnflag, l_linestatus, l_shipdate
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM l
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount,
                                    l_tax, l_returnflag, l_linestatus) = 1""",
})
