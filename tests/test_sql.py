"""Every query that has SQL gives the same rows as the SQL."""

import pytest

from nestra.plans import pipeline, reference

BOTH = reference.QUERIES | pipeline.QUERIES
SQL = reference.SQL | pipeline.SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, against_sql, name):
    against_sql(spark, BOTH[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(BOTH) - set(SQL)))
def test_runs_without_sql(spark, name):
    df = BOTH[name](spark, "/root/testdata/sf0.001")
    assert df.count() > 0


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
