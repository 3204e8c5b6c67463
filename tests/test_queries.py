"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_check import compare, connect
from tapeline.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, con, name):
    message, rows = compare(spark, con, name, catalogue.QUERIES[name], catalogue.ORACLE.get(name), SF)
    assert message is None
    assert rows >= 0


def test_operator_ids_are_named():
    assert all(catalogue.OPERATORS[n] for n in catalogue.QUERIES)
