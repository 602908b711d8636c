import pytest
from compare import difference

from contactloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_gives_the_rows_of_its_sql(spark, name):
    assert difference(queries.QUERIES[name], queries.ORACLE_SQL[name], spark, "/root/testdata/sf0.001") == ""
