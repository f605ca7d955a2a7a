"""The text queries that SQL can express, against their SQL on the smallest input."""

import pytest
from oracle_compare import connection, difference

from chronomart.llm.queries import ORACLE, REGISTRY

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(REGISTRY[name](spark, SMALL), connection(SMALL), ORACLE[name]) is None
