import pytest
from oracle import spark_rows, sql_rows

from corpusmill.plans import queries as own

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", own.oracle_sql())
def test_query_equals_its_sql(spark, name):
    assert spark_rows(own.queries()[name](spark, SF)) == sql_rows(own.oracle_sql()[name], SF)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).where("error is null and md <> ''").count() == 50
