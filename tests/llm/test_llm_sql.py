import pytest
from sqlcheck import assert_same

from casemill.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_its_sql(spark, name):
    assert_same(spark, queries.QUERIES[name], queries.SQL[name])


def test_nothing_else_imports_this_package():
    from pathlib import Path

    root = Path(queries.__file__).resolve().parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "casemill.llm" not in path.read_text()
