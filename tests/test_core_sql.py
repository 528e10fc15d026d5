import pytest
from sqlcheck import assert_same

from casemill.plans import core_queries, core_sql


@pytest.mark.parametrize("name", sorted(core_sql.SQL))
def test_query_matches_its_sql(spark, name):
    assert_same(spark, core_queries.QUERIES[name], core_sql.SQL[name])


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
