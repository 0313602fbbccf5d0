"""Every registered query agrees with its SQL, in values and in types."""

import pytest

from registry.compare import difference, duck
from registry.oracle import ORACLES
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
}


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = connection.sql(ORACLES[name])
    found = dict(zip(relation.columns, map(str, relation.types)))
    assert {column: TYPES[kind] for column, kind in df.dtypes} == found
    assert difference([tuple(r) for r in df.collect()], df.columns, relation.fetchall(), relation.columns) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
