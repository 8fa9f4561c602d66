"""Small helpers of the pipeline operators: tables, written intermediate results, columns."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import work_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, kept when executors are lost."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Let Spark hand this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp(prefix="tidegate-")) / "tidegate-package.zip"
        with zipfile.ZipFile(path, "w") as bundle:
            for file in sorted(root.rglob("*.py")):
                bundle.write(file, file.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(path))
        _SHIPPED.add(app)
    return spark
