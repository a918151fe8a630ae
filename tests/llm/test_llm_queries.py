"""Every training-data query that has SQL, against it."""

import pytest

from loamstone.llm import queries
from tests.conftest import same


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, data, name):
    same(spark, data, queries.QUERIES[name], queries.SQL[name])
