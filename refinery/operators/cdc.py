"""Change data capture over a change log ``(lsn, seq, operation, key…, image…)``.

Operations may be names (``INSERT``, ``UPDATE``, ``DELETE``, ``UPDATE (before)``,
``UPDATE (after)``) or the numeric codes of a change table; :func:`normalise`
brings both to one form, and every public operator calls it once. The commit order is
``(lsn, seq)``. Ranges include both ends unless ``include_hi=False``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import decode
from ..session import child_dirs, path_exists
from ..sources import buckets
from .rules import flag_first
from .sequence import carry, zero_of

# Numeric change-table operation codes and their names.
OP_CODES = {1: "DELETE", 2: "INSERT", 3: "UPDATE (before)", 4: "UPDATE (after)"}
BEFORE = "UPDATE (before)"


# What a log may write, in upper case, and the one form that the operators compare with.
_FORMS = {**{str(code): name for code, name in OP_CODES.items()}, "UPDATE (BEFORE)": BEFORE,
          "UPDATE (AFTER)": "UPDATE", "4": "UPDATE"}


def decode_operation(code: Column | str) -> Column:
    return decode(code, OP_CODES)


def normalise(log: DataFrame, op: str = "operation") -> DataFrame:
    """Operations as INSERT, UPDATE, DELETE or ``UPDATE (before)``, whatever form the log has.

    One look-up in a literal map, since the optimizer writes the expression out wherever the
    column is used. The public operators call it once, at their edge; what is stored stays normalised.
    """
    c = F.col(op).cast("int") if isinstance(log.schema[op].dataType, T.NumericType) else F.col(op)
    text = F.upper(F.trim(c.cast("string")))
    forms = F.create_map(*[F.lit(x) for pair in _FORMS.items() for x in pair])
    return log.withColumn(op, F.coalesce(F.try_element_at(forms, text), text))


def _changes_only(log: DataFrame, op: str) -> DataFrame:
    """A normalised log without before-images."""
    return log.filter(F.col(op) != BEFORE)


def after_images(log: DataFrame, op: str = "operation") -> DataFrame:
    """The normalised log without before-images: one row a change."""
    return _changes_only(normalise(log, op), op)


def in_range(log: DataFrame, lo, hi, lsn: str = "lsn", include_hi: bool = True) -> DataFrame:
    """Rows with ``lo <= lsn <= hi`` (``< hi`` with ``include_hi=False``); None leaves an end open."""
    c = F.col(lsn)
    out = log
    if lo is not None:
        out = out.filter(c >= F.lit(lo).cast(log.schema[lsn].dataType))
    if hi is not None:
        end = F.lit(hi).cast(log.schema[lsn].dataType)
        out = out.filter(c <= end if include_hi else c < end)
    return out


def in_commit_order(changes: DataFrame, lsn: str = "lsn", seq: str = "seq") -> DataFrame:
    """Changes sorted as they were committed, for a sink that keeps order."""
    return changes.orderBy(lsn, seq)


def all_changes(log: DataFrame, lo, hi, lsn: str = "lsn", op: str = "operation", include_hi: bool = True) -> DataFrame:
    """Every change in range with its after-image (net of nothing)."""
    return after_images(in_range(log, lo, hi, lsn, include_hi), op)


def all_changes_update_old(log: DataFrame, keys: Sequence[str], image: Sequence[str], lo, hi,
                           lsn: str = "lsn", seq: str = "seq", op: str = "operation",
                           include_hi: bool = True) -> DataFrame:
    """As ``all_changes`` plus, for each UPDATE, the row image before it
    (``UPDATE (before)``); updates themselves become ``UPDATE (after)``.

    Before-images that the log holds are used. Otherwise the before-image is
    that of the key's previous change, wherever in the log: of the changes
    before the range, each changed key contributes its last one (a partial
    aggregate), so the ordered pass runs over the range alone.
    """
    log = normalise(log, op)
    cols = [lsn, seq, *keys, op, *image]
    rng = in_range(log, lo, hi, lsn, include_hi).select(*cols, F.when(F.col(op) == BEFORE, 0).otherwise(1).alias("__phase"))
    if lo is not None:
        first = F.lit(lo).cast(log.schema[lsn].dataType)
        earlier = log.filter((F.col(lsn) < first) & (F.col(op) != BEFORE))
        changed = rng.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct()
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & earlier[k].eqNullSafe(changed[f"__k{i}"])
        last = F.max(F.struct(F.col(lsn), F.col(seq), *[F.col(c).alias(c) for c in image])).alias("__l")
        seeds = earlier.join(changed, cond, "left_semi").groupBy(*keys).agg(last).select(
            F.col(f"__l.{lsn}").alias(lsn), F.col(f"__l.{seq}").alias(seq), *keys, F.lit("SEED").alias(op),
            *[F.col(f"__l.{c}").alias(c) for c in image], F.lit(1).alias("__phase"))
        rng = rng.unionByName(seeds)
    withprev = carry(rng, keys, [lsn, seq, "__phase"], list(image), prefix="__prev_").filter(
        (F.col(op) != BEFORE) & (F.col(op) != "SEED"))
    after = F.struct(*[F.col(c).alias(c) for c in (lsn, seq, *keys)],
                     F.when(F.col(op) == "UPDATE", F.lit("UPDATE (after)")).otherwise(F.col(op)).alias(op),
                     *[F.col(c).alias(c) for c in image])
    before = F.struct(*[F.col(c).alias(c) for c in (lsn, seq, *keys)], F.lit(BEFORE).alias(op),
                      *[F.col(f"__prev_{c}").alias(c) for c in image])
    rows = F.when(F.col(op) == "UPDATE", F.array(before, after)).otherwise(F.array(after))
    return withprev.select(F.explode(rows).alias("__r")).select("__r.*").select(lsn, seq, *keys, op, *image)


def _first_last(changes: DataFrame, keys: Sequence[str], image: Sequence[str],
                lsn: str, seq: str, op: str) -> DataFrame:
    """Per key: first operation and last (operation, image) by (lsn, seq).
    Aggregates combine map-side, so a hot key costs one row per task."""
    first = F.min(F.struct(F.col(lsn), F.col(seq), F.col(op).alias("op")))
    last = F.max(F.struct(F.col(lsn), F.col(seq), F.col(op).alias("op"),
                          *[F.col(c).alias(c) for c in image]))
    return changes.groupBy(*keys).agg(first.alias("__f"), last.alias("__l"))


def net_changes(log: DataFrame, keys: Sequence[str], image: Sequence[str], lo, hi,
                lsn: str = "lsn", seq: str = "seq", op: str = "operation",
                out_op: str = "net_operation", include_hi: bool = True) -> DataFrame:
    """One row per key changed in range: its net effect and final image.

    first INSERT … last DELETE → no row; first INSERT → INSERT; last DELETE →
    DELETE; anything else → UPDATE.
    """
    fl = _first_last(all_changes(log, lo, hi, lsn, op, include_hi), keys, image, lsn, seq, op)
    f, l = F.col("__f.op"), F.col("__l.op")
    net = (F.when(f == "INSERT", F.lit("INSERT")).when(l == "DELETE", F.lit("DELETE"))
           .otherwise(F.lit("UPDATE")))
    return (fl.filter(~((f == "INSERT") & (l == "DELETE")))
            .select(net.alias(out_op), *keys, *[F.col(f"__l.{c}").alias(c) for c in image],
                    F.col(f"__l.{lsn}").alias(f"last_{lsn}")))


def last_state(changes: DataFrame, keys: Sequence[str], image: Sequence[str],
               lsn: str = "lsn", seq: str = "seq", op: str = "operation") -> DataFrame:
    """Per key: the last change by (lsn, seq) — keys, operation, image, lsn, seq. Deleted
    keys stay in it with their DELETE, so a state kept this way also refuses changes
    that arrive late."""
    return stored_last_state(normalise(changes, op), keys, image, lsn, seq, op)


def stored_last_state(changes: DataFrame, keys: Sequence[str], image: Sequence[str],
                      lsn: str = "lsn", seq: str = "seq", op: str = "operation") -> DataFrame:
    """:func:`last_state` of changes that are normalised already."""
    last = F.max(F.struct(F.col(lsn), F.col(seq), F.col(op).alias("op"), *[F.col(c).alias(c) for c in image]))
    return _changes_only(changes, op).groupBy(*keys).agg(last.alias("__l")).select(
        *keys, F.col("__l.op").alias(op), *[F.col(f"__l.{c}").alias(c) for c in image],
        F.col(f"__l.{lsn}").alias(lsn), F.col(f"__l.{seq}").alias(seq))


def live(state: DataFrame, op: str = "operation") -> DataFrame:
    """The rows of a state that are not deleted."""
    return state.filter(F.col(op) != "DELETE")


def fold(base: DataFrame, changes: DataFrame, keys: Sequence[str], image: Sequence[str],
         lsn: str = "lsn", seq: str = "seq", op: str = "operation") -> DataFrame:
    """State after both: per key the last of base row and changes by (lsn, seq), deletes kept.

    A base without ``operation`` holds live rows; one without ``seq`` gives way
    to a change of the same lsn, one without ``lsn`` to any change.
    """
    return stored_fold(base, normalise(changes, op), keys, image, lsn, seq, op)


def stored_fold(base: DataFrame, changes: DataFrame, keys: Sequence[str], image: Sequence[str],
                lsn: str = "lsn", seq: str = "seq", op: str = "operation") -> DataFrame:
    """:func:`fold` of a state and changes that are normalised already."""
    kind = {f.name: f.dataType for f in changes.schema}
    held = base.select(*keys, *image,
                       *[F.col(c) if c in base.columns else F.lit(None).cast(kind[c]).alias(c) for c in (lsn, seq)],
                       F.col(op) if op in base.columns else F.lit("UPDATE").alias(op))
    return stored_last_state(held.unionByName(changes.select(*held.columns)), keys, image, lsn, seq, op)


def apply_changes(base: DataFrame, changes: DataFrame, keys: Sequence[str], image: Sequence[str],
                  lsn: str = "lsn", seq: str = "seq", op: str = "operation") -> DataFrame:
    """State after applying ``changes`` to ``base`` (one row per live key, the columns of ``base``).

    Uses the last operation per key (not the net change): a key whose range
    is INSERT … DELETE is removed even if ``base`` already held it. A change
    older than the base row leaves it as it is. To refuse late changes of keys
    that are deleted already, keep the state of :func:`fold`.
    """
    return live(fold(base, changes, keys, image, lsn, seq, op), op).select(*base.columns)


def apply_to_buckets(changes: DataFrame, root: str, keys: Sequence[str], image: Sequence[str], batch_id: str,
                     lsn: str = "lsn", seq: str = "seq", op: str = "operation", **options) -> list[int]:
    """Row DML whose cost follows the change: the buckets of the changed keys are rewritten, the others
    stay as they are. Deleted keys stay with their (lsn, seq), so a late change loses to what it is older
    than. Returns the rewritten buckets; a batch that was taken before changes nothing."""
    cols = [*keys, op, *image, lsn, seq]
    fresh = normalise(changes, op).select(*cols)

    def merge(old: DataFrame, batch: DataFrame) -> dict[str, DataFrame]:
        return {"rows": stored_fold(old, batch, keys, image, lsn, seq, op).select(*cols)}

    return buckets.rewrite(fresh, root, keys, batch_id, fresh.schema, merge, **options)


def bucketed_state(spark, root: str, schema, op: str = "operation", load: int | None = None) -> DataFrame:
    """The live rows of a state that :func:`apply_to_buckets` keeps, as of a load."""
    return live(buckets.read(spark, root, schema, load=load), op)


def replay(log: DataFrame, keys: Sequence[str], image: Sequence[str], hi,
           lsn: str = "lsn", seq: str = "seq", op: str = "operation", include_hi: bool = True) -> DataFrame:
    """State at ``hi`` from an empty start (last change per key, deletes removed)."""
    state = last_state(in_range(log, None, hi, lsn, include_hi), keys, image, lsn, seq, op)
    return live(state, op).select(*keys, *image, lsn, seq)


def incremental(log: DataFrame, high_water_mark, lsn: str = "lsn") -> DataFrame:
    """Changes strictly after the last processed lsn (exclusive high-water mark)."""
    if high_water_mark is None:
        return log
    return log.filter(F.col(lsn) > F.lit(high_water_mark).cast(log.schema[lsn].dataType))


def load_incremental(log: DataFrame, root: str, lsn: str = "lsn") -> int:
    """Copy what lies beyond the stored high-water mark to ``root`` and store the new mark.

    Load ``n`` writes ``root/changes/load=<n>`` and, once that has committed, its
    mark ``root/marks/load=<n>``. A load that died between the two has no mark,
    so the next run writes the same load again. Returns the number of rows.
    """
    spark = log.sparkSession
    done = sorted(int(d.split("=")[1]) for d in child_dirs(spark, f"{root}/marks"))
    mark = spark.read.parquet(f"{root}/marks/load={done[-1]}").first()["mark"] if done else None
    fresh = incremental(log, mark, lsn)
    upto, n = fresh.agg(F.max(lsn), F.count(F.lit(1))).first()
    if not n:
        return 0
    load = done[-1] + 1 if done else 0
    in_range(fresh, None, upto, lsn).write.mode("overwrite").parquet(f"{root}/changes/load={load}")
    spark.createDataFrame([(upto,)], f"mark {log.schema[lsn].dataType.simpleString()}").coalesce(1) \
        .write.mode("overwrite").parquet(f"{root}/marks/load={load}")
    return n


def loaded(spark, root: str) -> DataFrame:
    """All committed loads of :func:`load_incremental`."""
    done = [d for d in child_dirs(spark, f"{root}/marks") if path_exists(spark, f"{root}/changes/{d}")]
    return spark.read.option("basePath", f"{root}/changes").parquet(*[f"{root}/changes/{d}" for d in done])


def incremental_by_timestamp(df: DataFrame, col: str, last_run) -> DataFrame:
    """The timestamp-watermark extract (``updated_at > last_run``); see
    :func:`watermark_gap` for what it cannot see (deletes, intermediate states)."""
    return incremental(df, last_run, col)


def watermark_gap(log: DataFrame, keys: Sequence[str], lo, hi, row_id: Sequence[str],
                  lsn: str = "lsn", seq: str = "seq", op: str = "operation",
                  include_hi: bool = True) -> DataFrame:
    """What an ``updated_at > last_run`` extract misses compared with CDC.

    Each change in range is ``missed_delete`` (the row is gone, a timestamp
    filter cannot see it), ``missed_intermediate`` (a later change of the key
    in range overwrote it) or ``captured``.
    """
    rng = all_changes(log, lo, hi, lsn, op, include_hi)
    flagged = flag_first(rng, keys, [lsn, seq], row_id, flag="__is_last", last=True)
    kind = (F.when(F.col(op) == "DELETE", F.lit("missed_delete"))
            .when(~F.col("__is_last"), F.lit("missed_intermediate")).otherwise(F.lit("captured")))
    return flagged.groupBy(kind.alias("gap_kind")).agg(F.count(F.lit(1)).alias("changes"))


def map_commit_time(changes: DataFrame, txn_map: DataFrame, on: str, time_col: str = "commit_time") -> DataFrame:
    """Attach the commit time of each change's transaction (equi join on the
    transaction id; the map has one row per transaction)."""
    return changes.join(txn_map.select(on, time_col), on, "left")


def map_range_time(changes: DataFrame, marks: DataFrame, lsn: str = "lsn", start: str = "start_lsn",
                   time_col: str = "commit_time") -> DataFrame:
    """Attach the time of the log range each change lies in, where the map names the ranges' starts only:
    that of the last mark at or before the change.

    There is no key to join on, so changes and marks are put in one order of the log, cut into range chunks, and the last mark
    is carried from chunk to chunk (:func:`carry`); between chunks there is one row a chunk. A position with many changes
    spans chunks, since a hash of the row orders them further. Of marks with one start the latest time
    counts. Changes before the first mark, or without a position, have no time; marks without start or time are ignored.
    """
    time_type, names = marks.schema[time_col].dataType, changes.columns
    at = lambda df, c: df[c].cast(changes.schema[lsn].dataType).alias("__at")
    kept = marks.filter(F.col(start).isNotNull() & F.col(time_col).isNotNull())
    points = kept.select(at(kept, start), F.lit(False).alias("__change"), F.col(time_col).alias("__time"), F.lit(0).cast("long").alias("__tie"),
                         F.lit(None).cast(changes.schema).alias("__row"))
    rows = changes.filter(F.col(lsn).isNotNull())
    rows = rows.select(at(rows, lsn), F.lit(True).alias("__change"), zero_of(time_type).alias("__time"), F.xxhash64(*names).alias("__tie"),
                       F.struct(*names).alias("__row"))
    found = carry(points.unionByName(rows), [], ["__at", "__change", "__time", "__tie"], ["__time"], present=~F.col("__change"), prefix="found")
    out = found.filter("__change").select("__row.*", F.col("found__time").alias(time_col))
    return out.unionByName(changes.filter(F.col(lsn).isNull()).withColumn(time_col, F.lit(None).cast(time_type)))
