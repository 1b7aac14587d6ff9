import pytest

from nestra.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, against_sql, name):
    against_sql(spark, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs_without_sql(spark, name):
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
