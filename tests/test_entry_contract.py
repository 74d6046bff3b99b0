"""Driver contract of __spark_entry__."""

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF_SMALL
from emporion.plans.queries import QUERIES


def test_keys_match_and_columns_are_named(spark):
    qs, sql = QUERIES, oracle_sql()
    assert set(qs) <= set(sql) <= set(queries()) and len(qs) == 42
    for name, fn in qs.items():
        cols = fn(spark, SF_SMALL).columns
        assert len(cols) == len(set(cols)), name
        assert all(c.isidentifier() for c in cols), (name, cols)


def test_entry_schema_is_stable(spark):
    a, b = entry(spark), entry(spark)
    assert a.schema == b.schema
    assert a.count() == b.count() > 0
