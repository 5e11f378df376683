"""The entry points, and equal column types in both engines."""

import pytest

import __spark_entry__ as entry_points
from patronage.plans.catalog import QUERIES
from patronage.plans.oracle import ORACLE
from tests.oracle_check import connect

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.count() == 150
    assert "RFM_Score" in df.columns


def test_dictionaries():
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLE.items() <= entry_points.oracle_sql().items()
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_types(spark, small, connection, name):
    found = {c: SAME_TYPE[t] for c, t in QUERIES[name](spark, small).dtypes}
    described = connection.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert found == {row[0]: row[1] for row in described}
