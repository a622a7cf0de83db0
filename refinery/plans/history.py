"""History queries: SCD2 versions of each user's latest event type, as-of read and as-of join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc, history
from ..session import materialize, scratch_dir
from .common import t
from .registry import attach, query

# The as-of instant.
AS_OF = "2024-01-15 00:00:00"


def user_history(spark, sf):
    e = t(spark, sf, "events")
    return history.scd2(e, ["user_id"], ["ts", "event_id"], ["event_type"])


@query("scd2_history")
def scd2_history(spark, sf):
    return user_history(spark, sf)


@query("scd2_with_deletes")
def scd2_with_deletes(spark, sf):
    """Versions of a change log: a DELETE closes the period, a later change opens a new one."""
    from .cdc import change_log
    return history.scd2(change_log(spark, sf), ["user_id"], ["lsn", "seq"], ["event_type"], op="operation")


@query("history_incremental")
def history_incremental(spark, sf):
    """The history of a change log taken in three batches, the middle one last; it is that of the whole log."""
    from .cdc import HI, LO, change_log
    root = scratch_dir(spark, "history")
    log = change_log(spark, sf)
    for name, batch in (("a", cdc.in_range(log, None, LO, include_hi=False)), ("c", cdc.in_range(log, HI, None)),
                        ("b", cdc.in_range(log, LO, HI, include_hi=False))):
        history.merge_history(batch, root, ["user_id"], ["lsn", "seq"], ["event_type"], name, op="operation", buckets=16)
    schema = "user_id long, event_type string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    return history.stored_history(spark, root, schema)


@query("as_of")
def as_of(spark, sf):
    return history.as_of(user_history(spark, sf), AS_OF)


@query("as_of_join")
def as_of_join(spark, sf):
    purchases = (t(spark, sf, "events").filter(F.col("event_type") == "purchase")
                 .select("event_id", "user_id", "ts", "value"))
    # written once: the join samples its input and then reads it
    return history.as_of_join(purchases, materialize(user_history(spark, sf), "history"), ["user_id"], "ts", ["event_type"])


@query("as_of_join_just_before")
def as_of_join_just_before(spark, sf):
    """The version in force before the purchase's own instant."""
    purchases = (t(spark, sf, "events").filter(F.col("event_type") == "purchase")
                 .select("event_id", "user_id", "ts", "value"))
    return history.as_of_join(purchases, materialize(user_history(spark, sf), "history"), ["user_id"], "ts", ["event_type"],
                              just_before=True)


HIST_SQL = """
s AS (
  SELECT user_id, ts, event_id, event_type,
         LAG(event_type) OVER w AS prev_type, LAG(ts) OVER w AS prev_ts
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
v AS (SELECT user_id, event_type, ts, event_id FROM s
      WHERE prev_ts IS NULL OR prev_type IS DISTINCT FROM event_type),
hist AS (
  SELECT user_id, event_type, ts AS valid_from,
         COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                  TIMESTAMP '9999-12-31 00:00:00') AS valid_to
  FROM v)"""

_WITH_DELETES = """
WITH log AS (
  SELECT user_id, ts, event_id, event_type, event_type <> 'error' AS live FROM events),
s AS (
  SELECT *, LAG(event_type) OVER w AS prev_type, COALESCE(LAG(live) OVER w, FALSE) AS prev_live
  FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (
  SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
  FROM s WHERE CASE WHEN live THEN NOT prev_live OR prev_type IS DISTINCT FROM event_type ELSE prev_live END)
SELECT user_id, event_type, ts AS valid_from, COALESCE(next_ts, TIMESTAMP '9999-12-31 00:00:00') AS valid_to
FROM b WHERE live"""

attach({
    "history_incremental": _WITH_DELETES,
    "scd2_history": f"WITH {HIST_SQL} SELECT * FROM hist",
    "as_of": f"""WITH {HIST_SQL} SELECT * FROM hist
WHERE valid_from <= TIMESTAMP '2024-01-15 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00' < valid_to""",
    "as_of_join": f"""WITH {HIST_SQL}
SELECT e.event_id, e.user_id, e.ts, e.value, h.event_type AS version_event_type,
       h.valid_from AS version_valid_from, h.valid_to AS version_valid_to
FROM events e JOIN hist h ON h.user_id = e.user_id AND h.valid_from <= e.ts AND e.ts < h.valid_to
WHERE e.event_type = 'purchase'""",
    "as_of_join_just_before": f"""WITH {HIST_SQL}
SELECT e.event_id, e.user_id, e.ts, e.value, h.event_type AS version_event_type,
       h.valid_from AS version_valid_from, h.valid_to AS version_valid_to
FROM events e JOIN hist h ON h.user_id = e.user_id AND h.valid_from < e.ts AND e.ts <= h.valid_to
WHERE e.event_type = 'purchase'""",
    "scd2_with_deletes": _WITH_DELETES,
})
