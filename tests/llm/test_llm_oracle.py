"""Queries that SQL can express against DuckDB."""

import pytest

from compare import difference
from legajo.llm.oracle import SQL
from legajo.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, name):
    assert difference(spark, name, QUERIES[name], SQL[name], SF) is None
