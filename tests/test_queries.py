"""Every query of the core against its SQL on the smallest tables."""

import pytest

from loamstone.plans import catalogue
from tests.conftest import same


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_same_as_sql(spark, data, name):
    same(spark, data, catalogue.QUERIES[name], catalogue.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_runs(spark, data, name):
    df = catalogue.QUERIES[name](spark, data)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)
