"""The operators' queries next to their oracle SQL, where SQL can say it; the others have tests of their own."""

import sys
from pathlib import Path

import pytest
from conftest import SF

from setforge.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from compare import compare, oracle_connection  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    good, note = compare(spark, oracle_connection(SF), SF, QUERIES[name], ORACLES[name])
    assert good, note
