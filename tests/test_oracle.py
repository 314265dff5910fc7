"""Every registered query of the library next to its oracle SQL on the smallest data."""

import pytest

import __spark_entry__ as contract
from compare import compare
from conftest import SF
from setforge.queries import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(ORACLES) == set(QUERIES)
    assert contract.entry(spark).columns[:2] == ["boxid", "pid"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    good, note = compare(spark, oracle, SF, QUERIES[name], ORACLES[name])
    assert good, note
