"""Registered queries against their SQL; the others have rows of a stable shape."""

import pytest
from check_oracle import compare, duck

from __spark_entry__ import queries
from marklens.llm.oracle import ORACLE
from marklens.llm.queries import QUERIES

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal(spark, sf, name):
    assert compare(spark, duck(sf), sf, name) is None


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(queries())
