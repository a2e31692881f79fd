"""Every registered query equals its DuckDB oracle SQL, value for value (sf0.001)."""

import datetime as dt
import math
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shelfwise.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.date().isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return None if v is None else str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    rel = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, df.collect()) == canon(dcols, rel.fetchall())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["product_id", "sku", "product_name", "category_name", "units_sold", "revenue"]
    assert 0 < df.count() <= 20
