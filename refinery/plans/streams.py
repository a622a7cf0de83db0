"""Streaming operators over ``events`` delivered as two file drops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rules import Rule, any_null, classify, flag_exists, flag_first
from ..session import scratch_dir
from ..streaming.incremental import foreach_batch_apply, foreach_batch_classify, land_incremental, land_once, latest_state
from .common import t
from .registry import attach, query

# The split instant between the two drops, allowed event types, value ceiling.
SPLIT = "2024-01-15 00:00:00"
EVENT_TYPES = ["click", "view", "purchase", "signup"]
MAX_VALUE = 400


def _drops(spark, sf):
    e = t(spark, sf, "events")
    cut = F.lit(SPLIT).cast("timestamp_ntz")
    return e, e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut)


@query("incremental_land")
def incremental_land(spark, sf):
    root = scratch_dir(spark, "stream")
    events, first, second = _drops(spark, sf)
    src, sink, ckpt = f"{root}/src", f"{root}/sink", f"{root}/_checkpoint"
    first.write.mode("append").parquet(src)
    land_incremental(spark, src, events.schema, sink, ckpt)
    second.write.mode("append").parquet(src)
    land_incremental(spark, src, events.schema, sink, ckpt)     # reads only the new drop
    land_incremental(spark, src, events.schema, sink, ckpt)     # nothing new: adds nothing
    return spark.read.parquet(sink).select("event_id", "ts", "user_id", "event_type", "value")


def event_rules_classifier(spark, sf):
    valid_users = t(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)

    def run(batch: DataFrame, seen: DataFrame | None) -> DataFrame:
        df = flag_exists(batch, valid_users, [("user_id", "c_custkey")], "_user_ok")
        df = flag_first(df, ["user_id", "event_type"], ["ts", "event_id"], ["event_id"], flag="_first")
        if seen is not None:
            df = flag_exists(df, seen, ["user_id", "event_type"], "_seen")
        else:
            df = df.withColumn("_seen", F.lit(False))
        return classify(df, [
            Rule("MISSING_REQUIRED_FIELD", any_null("props", "value")),
            Rule("INVALID_USER", ~F.col("_user_ok")),
            Rule("INVALID_EVENT_TYPE", ~F.col("event_type").isin(*EVENT_TYPES)),
            Rule("VALUE_OUT_OF_RANGE", F.col("value") > MAX_VALUE),
            Rule("DUPLICATE_EVENT", F.col("_seen") | ~F.col("_first")),
        ]).drop("_user_ok", "_first", "_seen")
    return run


@query("stream_dq")
def stream_dq(spark, sf):
    root = scratch_dir(spark, "stream_dq")
    events, first, second = _drops(spark, sf)
    src, sink, ckpt = f"{root}/src", f"{root}/sink", f"{root}/_checkpoint"
    run = event_rules_classifier(spark, sf)
    first.write.mode("append").parquet(src)
    foreach_batch_classify(spark, src, events.schema, sink, ckpt, run, ["user_id", "event_type"])
    second.write.mode("append").parquet(src)
    foreach_batch_classify(spark, src, events.schema, sink, ckpt, run, ["user_id", "event_type"])
    out = spark.read.parquet(sink)
    return (out.groupBy(F.coalesce(F.col("rejection_reason"), F.lit("ACCEPTED")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query("stream_cdc_apply")
def stream_cdc_apply(spark, sf):
    """The change log arrives as two drops; each micro-batch is applied to the state table."""
    from .cdc import IMAGE, KEYS, to_change_log as to_log
    root = scratch_dir(spark, "stream_cdc")
    events, first, second = _drops(spark, sf)
    src, state, ckpt = f"{root}/src", f"{root}/state", f"{root}/_checkpoint"

    first.write.mode("append").parquet(src)
    foreach_batch_apply(spark, src, events.schema, state, ckpt, KEYS, IMAGE, to_log, compact_every=1)
    second.write.mode("append").parquet(src)
    foreach_batch_apply(spark, src, events.schema, state, ckpt, KEYS, IMAGE, to_log, compact_every=1)
    return (latest_state(spark, state, KEYS, IMAGE)
            .select("user_id", "event_type", "value", F.col("lsn").alias("changed_at")))


@query("stream_cdc_late")
def stream_cdc_late(spark, sf):
    """The later drop of the change log arrives first; snapshots are taken after every batch."""
    from .cdc import IMAGE, KEYS, to_change_log as to_log
    root = scratch_dir(spark, "stream_late")
    events, first, second = _drops(spark, sf)
    src, state, ckpt = f"{root}/src", f"{root}/state", f"{root}/_checkpoint"
    for drop in (second, first):
        drop.write.mode("append").parquet(src)
        foreach_batch_apply(spark, src, events.schema, state, ckpt, KEYS, IMAGE, to_log, compact_every=1)
    return (latest_state(spark, state, KEYS, IMAGE)
            .select("user_id", "event_type", "value", F.col("lsn").alias("changed_at")))


@query("stream_dedupe")
def stream_dedupe(spark, sf):
    """Three drops with repeats inside each and of the drop before; every event lands once."""
    root = scratch_dir(spark, "stream_once")
    events = t(spark, sf, "events")
    at = lambda day: F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp_ntz")
    src, sink, ckpt = f"{root}/src", f"{root}/sink", f"{root}/_checkpoint"
    twice = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    # each drop begins a day before the last one ended, so that day is delivered again
    for lo, hi in ((None, 10), (9, 20), (19, None)):
        drop = events if lo is None else events.filter(F.col("ts") >= at(lo))
        drop = drop if hi is None else drop.filter(F.col("ts") < at(hi))
        drop.withColumn("__copy", F.explode(twice)).drop("__copy").write.mode("append").parquet(src)
        land_once(spark, src, events.schema, sink, ckpt, ["event_id"], "ts", "2 days")
    return spark.read.parquet(sink).select("event_id", "ts", "user_id", "event_type", "value")


_LAST_SQL = """
WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, event_type, value, ts AS changed_at FROM r WHERE rn = 1 AND event_type <> 'error'"""

attach({
    "stream_cdc_late": _LAST_SQL,
    "stream_cdc_apply": """
WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, event_type, value, ts AS changed_at FROM r WHERE rn = 1 AND event_type <> 'error'""",
    "stream_dedupe": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "incremental_land": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_dq": """
WITH c AS (
  SELECT e.*,
         EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_acctbal >= 0) AS user_ok,
         ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
  FROM events e)
SELECT COALESCE(CASE
    WHEN props IS NULL OR value IS NULL THEN 'MISSING_REQUIRED_FIELD'
    WHEN NOT user_ok THEN 'INVALID_USER'
    WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'INVALID_EVENT_TYPE'
    WHEN value > 400 THEN 'VALUE_OUT_OF_RANGE'
    WHEN rn > 1 THEN 'DUPLICATE_EVENT' END, 'ACCEPTED') AS outcome,
  COUNT(*) AS n_rows
FROM c GROUP BY 1""",
})
