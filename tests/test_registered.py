import pytest

import __spark_entry__ as entry
from tests import oracle


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_its_sql(spark, sf, con, name):
    assert oracle.compare(spark, con, sf, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
