"""Every SQL-expressible query gives the same rows in a second engine."""

import pytest

from patronage.plans.catalog import QUERIES
from patronage.plans.oracle import ORACLE
from tests.oracle_check import connect, oracle_result, spark_result


@pytest.fixture(scope="module")
def connection(medium):
    return connect(medium)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, medium, connection, name):
    names, rows = spark_result(QUERIES[name](spark, medium))
    expected_names, expected = oracle_result(connection, ORACLE[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    different = [(a, b) for a, b in zip(rows, expected) if a != b]
    assert not different, different[:3]
    assert expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)
