"""Every named query with an SQL oracle matches DuckDB on the driver tables (sf0.001)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from helpers import assert_same
from meterstream.plans.catalog import QUERIES
from meterstream.plans.oracle import ORACLE


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck(SF_SMALL).execute(ORACLE[name]).df()
    assert_same(got, want)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["building", "floor", "electricity", "water", "cluster", "dist", "timestamp"]
    assert df.count() == 9   # frozen model on sf0.001
