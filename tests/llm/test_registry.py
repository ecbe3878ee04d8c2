import __spark_entry__ as registry
import pytest

from compare import connect, differences
from rollcall.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_and_the_pipeline():
    names = [n.split("_")[0] for n in queries.queries()]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14))
    assert {*queries.queries(), "pipeline"} <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    assert differences(queries.queries()[name](spark, SMALL), connect(SMALL), queries.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_has_a_row_for_each_document(spark, name):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert queries.queries()[name](spark, SMALL).count() == n
