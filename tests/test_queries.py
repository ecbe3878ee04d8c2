"""Every registered query against its expected SQL, on the small test tables."""

import pytest

import __spark_entry__ as registry
from compare import SMALL, connect, differences

# The text operators have tests of their own.
TEXT = {"pipeline", *registry.text_queries.queries()} if registry.text_queries else set()
QUERIES = {name: query for name, query in registry.queries().items() if name not in TEXT}
EXPECTED = {name: text for name, text in registry.oracle_sql().items() if name not in TEXT}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    assert differences(df, duck, EXPECTED[name]) == []


def test_entry(spark):
    assert registry.entry(spark).count() > 0
