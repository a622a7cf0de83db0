"""Layout by several columns, bucketed tables, widening catalogue tables, time by log ranges."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.operators import cdc
from refinery.operators.interleave import interleaved, measure, rank, write_interleaved
from refinery.plans import layouts
from refinery.session import scratch_dir
from refinery.sources.catalog import SchemaConflict, register_table, wider

from .conftest import SF_MID


# ---------------------------------------------------------------- space-filling order

def touched(path, column, lo, hi):
    """(files with rows, files whose statistics overlap lo .. hi)."""
    found = []
    for f in glob.glob(f"{path}/*.parquet"):
        md = pq.ParquetFile(f).metadata
        if md.num_rows:
            at = md.schema.names.index(column)
            stats = [md.row_group(g).column(at).statistics for g in range(md.num_row_groups)]
            found.append(any(s.max >= lo and s.min <= hi for s in stats))
    return len(found), sum(found)


def test_filters_on_either_column_skip_files(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    path = scratch_dir(spark, "interleaved")
    write_interleaved(li, path, ["l_shipdate", "l_partkey"], num_files=64)
    files, by_date = touched(path, "l_shipdate", dt.datetime(1995, 1, 1), dt.datetime(1995, 3, 31))
    lo, hi = li.approxQuantile("l_partkey", [0.5, 0.55], 0.001)
    _, by_part = touched(path, "l_partkey", lo, hi)
    assert files == 64 and by_date <= 24 and by_part <= 24
    assert spark.read.parquet(path).exceptAll(li).isEmpty() and li.exceptAll(spark.read.parquet(path)).isEmpty()


def test_ranks_and_interleaved_bits(spark):
    cuts = [1.0, 2.0, 2.5, 7.0]
    rows = spark.createDataFrame([(v,) for v in (None, 0.0, 1.0, 2.2, 2.5, 9.0)], "v double")
    assert [r[0] for r in rows.select(rank(F.col("v"), cuts, 3)).collect()] == [0, 0, 1, 2, 3, 4]
    one = spark.range(1).select(interleaved([F.lit(0b101), F.lit(0b011)], 3)).first()[0]
    assert one == 0b100111


def test_layout_of_nulls_texts_frequent_values_and_no_rows(spark):
    rows = [(None if i % 7 == 0 else "hot" if i % 3 else f"t{i}", None if i % 5 == 0 else i, "é" * (i % 4)) for i in range(600)]
    df = spark.createDataFrame(rows, "a string, b int, __c string")
    path = scratch_dir(spark, "interleaved")
    write_interleaved(df, path, ["a", "b"], num_files=8, bits=4)
    assert sorted(map(repr, spark.read.parquet(path).collect())) == sorted(map(repr, df.collect()))
    none = scratch_dir(spark, "interleaved")
    write_interleaved(df.limit(0), none, ["a", "b"])
    assert spark.read.schema(df.schema).parquet(none).count() == 0


def test_measure_keeps_the_order_of_texts(spark):
    texts = ["", "a", "ab", "b", "zz", "é"]                    # in the order of their bytes
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(measure(F.col("t"), T.StringType())).collect()]
    assert got == sorted(got) and len(set(got)) == len(texts)


# ---------------------------------------------------------------- bucketed tables

@pytest.mark.parametrize("fact, dim", [(16, 16), (32, 16)])
def test_bucketed_join_has_no_exchange(spark, fact, dim):
    lines, orders = layouts.bucketed(spark, SF_MID, fact, dim)
    joined = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    assert joined.count() == spark.read.parquet(f"{SF_MID}/lineitem.parquet").count()
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


# ---------------------------------------------------------------- catalogue

def batch(spark, path, number, columns):
    spark.range(3).select(*[F.expr(c) for c in columns]).write.parquet(f"{path}/batch=2024010{number}T000000Z")


def test_types_widen_and_new_batches_join(spark):
    path, name = scratch_dir(spark, "zone"), "widened_orders"
    batch(spark, path, 1, ["CAST(id AS smallint) AS n", "CAST(id AS float) AS x", "DATE'2024-01-01' AS d", "CAST(id AS decimal(5,2)) AS m"])
    batch(spark, path, 2, ["CAST(id AS int) AS n", "CAST(id AS double) AS x", "DATE'2024-01-02' AS d", "CAST(id AS decimal(9,2)) AS m"])
    register_table(spark, name, path)
    batch(spark, path, 3, ["CAST(id + 5000000000 AS bigint) AS n", "CAST(id AS double) AS x", "DATE'2024-01-03' AS d", "'new' AS extra"])
    table = register_table(spark, name, path)
    assert dict(table.dtypes) == {"n": "bigint", "x": "double", "d": "date", "m": "decimal(9,2)", "extra": "string", "batch": "string"}
    got = spark.sql(f"SELECT batch, SUM(n) AS n, SUM(x) AS x, COUNT(extra) AS e, COUNT(m) AS m FROM {name} GROUP BY batch ORDER BY batch").collect()
    assert [(r["n"], r["x"], r["e"], r["m"]) for r in got] == [(3, 3.0, 0, 3), (3, 3.0, 0, 3), (15000000003, 3.0, 3, 0)]
    one = spark.sql(f"SELECT n FROM {name} WHERE batch = '20240102T000000Z'")
    assert one.count() == 3 and "PartitionFilters: [isnotnull(batch" in one._jdf.queryExecution().executedPlan().toString()


def test_an_incompatible_pair_is_reported(spark):
    path = scratch_dir(spark, "zone")
    batch(spark, path, 1, ["id", "'x' AS v"])
    batch(spark, path, 2, ["id", "1 AS v"])
    with pytest.raises(SchemaConflict, match="v: string in batch=20240101T000000Z, int in batch=20240102T000000Z"):
        register_table(spark, "clash", path)


def test_wider_types():
    assert wider(T.DecimalType(5, 2), T.DecimalType(4, 3)) == T.DecimalType(6, 3)
    assert wider(T.LongType(), T.DoubleType()) is None              # a double holds 53 bits
    assert wider(T.DecimalType(38, 2), T.DecimalType(38, 10)) is None
    assert wider(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType()
    assert wider(T.IntegerType(), T.DecimalType(5, 2)) == T.DecimalType(12, 2)


# ---------------------------------------------------------------- time by ranges of the log

def test_time_by_ranges_equals_a_plain_search(spark):
    marks = [(10, "b"), (10, "c"), (25, "d"), (40, None), (None, "z"), (60, "e")]
    rows = [(None, 1, "clash")] + [(50 if i % 3 == 0 else i % 70, i, "clash") for i in range(300)]
    changes = spark.createDataFrame(rows, "lsn int, seq int, start_lsn string")
    got = cdc.map_range_time(changes, spark.createDataFrame(marks, "start_lsn long, commit_time string"))
    good = sorted((s, c) for s, c in marks if s is not None and c is not None)
    want = [(*r, max((m for m in good if r[0] is not None and m[0] <= r[0]), default=(0, None))[1]) for r in rows]
    assert got.columns == ["lsn", "seq", "start_lsn", "commit_time"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_time_by_ranges_of_empty_tables(spark):
    changes = spark.createDataFrame([(1, 1)], "lsn int, seq int")
    none = spark.createDataFrame([], "start_lsn int, commit_time timestamp")
    assert cdc.map_range_time(changes, none).collect()[0]["commit_time"] is None
    assert cdc.map_range_time(changes.limit(0), none).collect() == []
