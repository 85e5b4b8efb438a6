import pytest
from oracle import spark_rows, sql_rows

from corpusmill.llm import entry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_equals_its_sql(spark, name):
    assert spark_rows(entry.queries()[name](spark, SF)) == sql_rows(entry.oracle_sql()[name], SF)


def test_names():
    assert [n.split("_")[0] for n in entry.queries()] == [f"op{k}" for k in range(1, 14)]
