"""Every query with SQL gives that SQL's rows; the others run and have a stable schema."""

import compare
import pytest

from contactloom import plans

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_gives_the_rows_of_its_sql(spark, name):
    assert compare.difference(plans.QUERIES[name], plans.ORACLE_SQL[name], spark, FOLDER) == ""


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert plans.QUERIES[name](spark, FOLDER).collect() is not None


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["p_partkey", "first_name", "last_name", "domain", "domain_source", "rank", "pattern", "email"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
