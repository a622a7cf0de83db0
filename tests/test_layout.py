"""Clustered layout: a range filter overlaps few files' min/max statistics."""

import datetime as dt
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from refinery.operators.layout import write_clustered
from refinery.session import scratch_dir

from .conftest import SF_MID


def _overlapping_files(path, lo, hi):
    n, hits = 0, 0
    for f in glob.glob(f"{path}/*.parquet"):
        md = pq.ParquetFile(f).metadata
        if md.num_rows == 0:
            continue
        n += 1
        idx = md.schema.names.index("l_shipdate")
        for rg in range(md.num_row_groups):
            st = md.row_group(rg).column(idx).statistics
            if st.max >= lo and st.min < hi:
                hits += 1
                break
    return n, hits


def test_clustered_layout_skips_files(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    clustered, scattered = scratch_dir(spark, "clustered"), scratch_dir(spark, "scattered")
    write_clustered(li, clustered, ["l_shipdate"], num_files=16)
    li.repartition(16).write.parquet(scattered)
    lo, hi = dt.datetime(1995, 1, 1), dt.datetime(1995, 4, 1)
    n_c, hit_c = _overlapping_files(clustered, lo, hi)
    n_s, hit_s = _overlapping_files(scattered, lo, hi)
    assert n_c == 16 and hit_c <= 2          # a quarter of one year touches at most two range files
    assert hit_s == n_s                      # unclustered: every file overlaps
    got = spark.read.parquet(clustered).filter((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi)).count()
    assert got == li.filter((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi)).count()
