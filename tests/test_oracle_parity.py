"""Every registered query equals its independent SQL oracle (DuckDB) on the
small test tables: same columns, same rows (order-insensitive)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL
from emporion.plans.queries import QUERIES

TABLES = ["nation", "customer", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _sorted(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(oracle_sql()))
    assert missing == []


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "gross_revenue" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    rel = duck.sql(oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    drows = [tuple(r[i] for i in order) for r in rel.fetchall()]
    srows = [tuple(r) for r in sdf.collect()]
    assert len(srows) == len(drows)
    assert _sorted(srows) == _sorted(drows)


@pytest.mark.parametrize("name", ["parse_orders", "valid_orders", "rejected_orders", "parse_clicks",
                                  "parse_inventory", "order_windows", "stg_orders", "hourly_revenue",
                                  "click_session_windows", "user_behavior", "dq_freshness", "dq_mart_sla",
                                  "inventory_stock", "user_sessions"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sdf = queries()[name](spark, SF_SMALL)
        srows = [tuple(r) for r in sdf.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = duck.sql(oracle_sql()[name])
    order = [rel.columns.index(c) for c in sdf.columns]
    drows = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert _sorted(srows) == _sorted(drows)
