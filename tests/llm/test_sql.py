"""Queries of the pipeline operators against their SQL."""

import pytest

from tests.oracle import compare, connection
from tidegate.llm import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query(spark, name):
    df = catalogue.queries()[name](spark, FOLDER)
    assert compare(df, connection(FOLDER), catalogue.oracle_sql()[name]).startswith("ok")
