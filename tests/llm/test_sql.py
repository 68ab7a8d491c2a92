"""The operators that SQL can express, against that SQL."""

import oracle
import pytest

from hazeline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, sf, name):
    assert oracle.compare(queries.queries()[name](spark, sf), oracle.connect(sf), queries.oracle_sql()[name]) is None
