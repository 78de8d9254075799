"""Every registered query against its DuckDB answer."""

import pytest

from __spark_entry__ import entry
from legajo.plans.oracle import ORACLE
from legajo.plans.queries import REGISTRY
from compare import difference, duck

SF = "/root/testdata/sf0.001"
# Columns that may be all the same value in the shipped tables.
FLAT = {"rucs", "dnis", "phones", "left_over", "part", "kind", "suffix", "parts_ok", "n_certificaciones",
        "system", "first_role", "model", "max_tokens", "temperature", "section", "errors", "docs"}


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, name):
    assert difference(spark, name, REGISTRY[name], ORACLE[name], SF) is None


@pytest.mark.parametrize("name", list(REGISTRY))
def test_answers_are_not_trivial(name):
    """Agreement on constants would prove nothing."""
    answer = duck(SF).sql(ORACLE[name]).df()
    assert len(answer) > 3
    for column in set(answer.columns) - FLAT:
        assert answer[column].nunique(dropna=False) > 1, column


def test_entry(spark):
    assert {r["lang"] for r in entry(spark).collect()} == {"de", "en", "es", "fr"}
