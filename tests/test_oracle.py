"""Every registered query against its SQL, and the contract of the entry point."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, duck
from marklens.plans.catalogue import QUERIES
from marklens.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal(spark, connection, name):
    assert compare(spark, connection, SF, name) is None


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_types(spark, connection, name):
    got = {n: DUCK_TYPES[t] for n, t in queries()[name](spark, SF).dtypes}
    cursor = connection.execute(oracle_sql()[name])
    assert got == {c[0]: str(c[1]) for c in cursor.description}


def test_queries_without_sql_have_rows(spark):
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"predict_support", "tree_evaluation", "tree_matrix", "tree_class_report", "tree_class_report_balanced"}
    for name in rows_only:
        assert queries()[name](spark, SF).count() > 0
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 5
