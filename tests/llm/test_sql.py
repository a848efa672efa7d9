"""The queries that have SQL, against it."""

import pytest

from clientele.llm import oracle, queries
from tests.conftest import SMALL
from verification.compare import connect, difference


@pytest.mark.parametrize("name", list(oracle.all_sql()))
def test_equals_sql(spark, name):
    assert difference(queries.all_queries()[name](spark, SMALL), connect(SMALL), oracle.all_sql()[name]) is None
