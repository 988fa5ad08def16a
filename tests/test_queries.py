"""Every query beside its SQL, over whole tables, as the driver compares them."""

import math
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__  # noqa: F401
from seqloom.plans import registry


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return str(v) if hasattr(v, "isoformat") or hasattr(v, "as_tuple") else v


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_oracle(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    r = duck.sql(registry.ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(r.columns)
    at = [r.columns.index(c) for c in cols]
    got = sorted((tuple(plain(x[c]) for c in cols) for x in df.collect()), key=str)
    assert got == sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_oracle_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.fixture
def gaps(spark, tmp_path):
    """Orders without a customer, without a date, and both; none are tied with a date."""
    c = duckdb.connect()
    c.sql("create view o as select * from (values (1, 7, '2000-01-01'), (2, 7, '2000-01-20'), (3, 7, null), (4, null, '2000-01-01'), (5, null, '2000-01-03'), (6, null, null), (7, 8, null), (8, 8, null)) t(o_orderkey, o_custkey, o_orderdate)")
    c.sql(f"copy (select o_orderkey::bigint as o_orderkey, o_custkey::bigint as o_custkey, o_orderdate::timestamp as o_orderdate from o) to '{tmp_path}/orders.parquet' (format parquet)")
    c.sql(f"create view orders as select * from '{tmp_path}/orders.parquet'")
    return str(tmp_path), c


@pytest.mark.parametrize("name", ["mean_span_depth", "overlap_groups"])
def test_orders_without_keys_or_dates(spark, gaps, name):
    d, c = gaps
    df, r = registry.QUERIES[name](spark, d), c.sql(registry.ORACLES[name])
    got = sorted((tuple(plain(x[k]) for k in r.columns) for x in df.collect()), key=str)
    assert got == sorted((tuple(map(plain, x)) for x in r.fetchall()), key=str)
