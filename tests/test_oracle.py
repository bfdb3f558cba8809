"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tools.verify import compare, open_oracle

from conftest import SF

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    problem, _ = compare(QUERIES[name](spark, SF), oracle, ORACLES.get(name))
    assert problem is None, problem


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
