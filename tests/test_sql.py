import pytest
from sqlcheck import assert_same, connect

from millrace.oracles import oracle_sql
from millrace.queries import queries


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, small, con, name):
    assert_same(spark, con, small, queries()[name], oracle_sql()[name])


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
