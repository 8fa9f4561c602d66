import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidegate.session import prepare

    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return prepare(session)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def frame(spark):
    """Frames of plain rows."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
