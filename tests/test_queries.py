"""Every registered query against its SQL, and what its plan must not contain."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connection
from tidegate.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()
OWN = catalogue.queries()  # the pipeline operators have tests of their own

# one row per partition, sorted to number the partitions
SINGLE_PARTITION_WINDOWS = {"positional_join", "config_upsert"}


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


def test_every_query_has_sql():
    assert set(OWN) <= set(QUERIES)
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, con, plan, name):
    df = QUERIES[name](spark, FOLDER)
    text = plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "MapInPandas"):
        assert bad not in text
    if name not in SINGLE_PARTITION_WINDOWS:
        assert not ("Exchange SinglePartition" in text and "Window" in text)
    assert compare(df, con, SQL[name]).startswith("ok")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0
