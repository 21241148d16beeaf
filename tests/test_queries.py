import pytest
from compare import SMALL, duck_rows, spark_rows

from tenderloom.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    got, want = spark_rows(QUERIES[name](spark, SMALL)), duck_rows(ORACLE[name], SMALL)
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1], "a query without rows checks nothing"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
