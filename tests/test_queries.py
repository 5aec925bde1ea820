"""Every registered query against its SQL on the smallest scale."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import connect, difference
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def other():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, other, name):
    if name in ORACLES:
        assert difference(QUERIES[name], ORACLES[name], spark, other, SMALL) is None
    else:
        assert QUERIES[name](spark, SMALL).count() >= 0


def test_entry_and_registry():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 120
