"""Every registered query with an oracle agrees with DuckDB at sf0.001."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, Decimal):
        return str(v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return c


def test_every_query_registered_has_oracle_or_reason():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_parity(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    s = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    d_idx = [rel.columns.index(c) for c in cols]
    d = sorted((tuple(_norm(r[i]) for i in d_idx) for r in rel.fetchall()), key=_key)
    assert s == d


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["rejection_reason", "rejected_count"]
    assert df.count() >= 0
