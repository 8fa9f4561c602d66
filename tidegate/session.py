"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Settings the operators rely on; all are runtime settings of the session.
SETTINGS = {
    # zone-less timestamps are UTC by convention
    "spark.sql.session.timeZone": "UTC",
    # keep execution ids such as "0012" as text when partition folders are read
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # a JSON object that repeats a key is legal; the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on and return the session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session that names none (unit tests) gets a folder of its own; on a
    cluster each executor would see another one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (root or tempfile.mkdtemp(prefix="tidegate-")).rstrip("/")


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared root; nothing is created yet."""
    return f"{shared_root(spark)}/tidegate/{label}-{uuid.uuid4().hex}"


def local_frame(spark: SparkSession, rows: list[tuple] | list[dict], schema: StructType) -> DataFrame:
    """A frame of driver-side rows whose exact size Catalyst knows.

    Frames made from plain Python lists have no size, so every join with one
    would be planned as a shuffle.
    """
    names = schema.fieldNames()
    records = [row if isinstance(row, dict) else dict(zip(names, row)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema=schema)
