"""Append-only tables partitioned by execution.

Each execution (batch id, run id) owns one leaf folder.  Pruning to it, counting
it and removing it touch no other execution's files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidegate.errors import (
    BRONZE_CLEANUP_DONE, BRONZE_CLEANUP_FAILED, BRONZE_CLEANUP_INCOMPLETE, BRONZE_CLEANUP_NOOP, LoadError,
)
from tidegate.functions.text import FOLDER_NAME
from tidegate.operators.evolution import check_type, declare_type, declared_types, merged
from tidegate.sources.files import store_uri

EXECUTION = ["_batch_id", "_pipeline_run_id"]
BROADCAST_EXECUTIONS = 200_000  # two names each; more are taken in parts


def checked_segment(name: str, value: str | None) -> str:
    """The value if it is safe as one folder name, else ValueError."""
    text = "" if value is None else str(value).strip()
    if not re.fullmatch(FOLDER_NAME, text):
        raise ValueError(f"{name} is not usable as one path segment: {value!r}")
    return text


def append_execution(df: DataFrame, table: str) -> int:
    """Append stamped rows and return how many were written.

    One pass: the count is observed while the files are written, directly below
    the write, so a lost or repeated task is counted once.  Columns new to the
    table are allowed; a column with another type is refused before the write.
    The columns are declared once the rows are there, so a failed write leaves no
    trace of its types.
    """
    row_type = StructType([field for field in df.schema.fields if field.name not in EXECUTION])
    check_type(df.sparkSession, table, row_type)
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("append").partitionBy(*EXECUTION).parquet(table)
    declare_type(df.sparkSession, table, row_type)
    return int(seen.get["rows"])


def read_bronze(spark: SparkSession, table: str) -> DataFrame:
    """All physical rows, of committed and uncommitted executions alike.

    The columns are those declared by the appends, so no data file is opened to
    find them.  A table written by other means has its footers merged.
    """
    types = declared_types(spark, table)
    if not types:
        return spark.read.option("mergeSchema", "true").parquet(table)
    ids = [StructField(name, StringType()) for name in EXECUTION]
    return spark.read.schema(StructType([*merged(types).fields, *ids])).parquet(table)


def committed_executions(bronze: DataFrame, audit: DataFrame) -> DataFrame:
    """Executions that have rows in the table and whose audit ended in SUCCESS.

    The table's side is its folder names alone: no column of the data is read, and only
    names are shuffled.
    """
    done = audit.where(F.col("status") == "SUCCESS").select(
        F.col("batch_id").alias("_batch_id"), F.col("pipeline_run_id").alias("_pipeline_run_id")
    )
    return bronze.select(*EXECUTION).distinct().join(done, EXECUTION, "left_semi")


def read_committed(bronze: DataFrame, audit: DataFrame, at_once: int = BROADCAST_EXECUTIONS) -> DataFrame:
    """Rows of executions whose audit ended in SUCCESS.

    However large the audit is, only the table's own committed executions meet the rows.
    They are broadcast, ``at_once`` at a time: a table with more of them is read as a union
    of parts, each pruned to its own folders, so every folder is read once and no row of the
    data is shuffled.
    """
    committed = committed_executions(bronze, audit).checkpoint()
    count = committed.count()
    parts = max(1, -(-count // max(1, at_once // 2)))  # parts by hash differ in size
    # the comparison holds for every folder name; it tells Spark that pruning is worth it
    committed = committed.where((F.col("_batch_id") > "") & (F.col("_pipeline_run_id") > ""))
    share = F.pmod(F.xxhash64(*EXECUTION), F.lit(parts))
    rows = [
        bronze.join(F.broadcast(committed.where(share == i) if parts > 1 else committed), EXECUTION, "left_semi")
        for i in range(parts)
    ]
    return reduce(DataFrame.unionByName, rows)


def orphan_executions(bronze: DataFrame, audit: DataFrame) -> DataFrame:
    """Executions with rows in the table but no SUCCESS audit, and their row counts."""
    present = bronze.groupBy(*EXECUTION).agg(F.count(F.lit(1)).alias("row_count"))
    done = audit.where(F.col("status") == "SUCCESS").select(
        F.col("batch_id").alias("_batch_id"), F.col("pipeline_run_id").alias("_pipeline_run_id")
    )
    return present.join(done, EXECUTION, "left_anti")


def folder_of(spark: SparkSession, path: str):
    """The file system of a path and the path as its object."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = folder_of(spark, path)
    return files.exists(target)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove one folder tree; True when nothing is left there."""
    files, target = folder_of(spark, path)
    if files.exists(target):
        files.delete(target, True)
    return not files.exists(target)


def execution_folder(spark: SparkSession, table: str, batch_id: str, run_id: str) -> str:
    """Folder of one execution, with the escaping the writer uses."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    batch = escape(checked_segment("batch_id", batch_id))
    run = escape(checked_segment("pipeline_run_id", run_id))
    return f"{table.rstrip('/')}/_batch_id={batch}/_pipeline_run_id={run}"


def delete_execution(spark: SparkSession, table: str, batch_id: str, run_id: str) -> int:
    """Remove exactly one execution's rows and return how many there were.

    Missing tables and executions are a successful no-op, so the call can be
    repeated.  The count before reads file footers only.
    """
    leaf = execution_folder(spark, table, batch_id, run_id)
    if not path_exists(spark, leaf):
        return 0
    try:
        before = spark.read.parquet(leaf).count()
    except Exception as problem:  # a leaf without one complete file
        if "UNABLE_TO_INFER_SCHEMA" not in str(problem):
            raise
        before = 0
    if not remove_folder(spark, leaf):
        raise LoadError(BRONZE_CLEANUP_INCOMPLETE, f"rows of run {run_id} remain in {table}")
    return before


REMOVED = "target string, batch_id string, pipeline_run_id string, outcome string, rows_before long, message string"
_ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")  # what partition folders write as %XX


def _folder_part(value: str) -> str:
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value)


def qualified(spark: SparkSession, path: str) -> str:
    files, target = folder_of(spark, path)
    return files.makeQualified(target).toString().rstrip("/")


def delete_executions(executions: DataFrame) -> DataFrame:
    """Remove many executions' rows (``target``, ``batch_id``, ``pipeline_run_id``) in tasks.

    Every task removes the leaf folders of its rows and nothing else; the outcomes come back
    as a frame, one row each: ``BRONZE_CLEANUP_DONE`` with the rows there were (from file
    footers), ``BRONZE_CLEANUP_NOOP`` where nothing lay, ``BRONZE_CLEANUP_INCOMPLETE`` or
    ``BRONZE_CLEANUP_FAILED`` with the reason. A repeated task finds nothing left to do, so
    write or checkpoint the frame once before reading it twice. Targets are qualified paths.
    """

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [(*key, *_remove_leaf(*key)) for key in batch.itertuples(index=False, name=None)],
                columns=["target", "batch_id", "pipeline_run_id", "outcome", "rows_before", "message"],
            )

    keys = executions.select("target", "batch_id", "pipeline_run_id").distinct()
    width = 4 * executions.sparkSession.sparkContext.defaultParallelism
    return keys.repartition(width, "target", "batch_id", "pipeline_run_id").mapInPandas(remove, REMOVED)


def _remove_leaf(target: str, batch_id: str, run_id: str) -> tuple[str, int | None, str | None]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    try:
        batch, run = checked_segment("batch_id", batch_id), checked_segment("pipeline_run_id", run_id)
        leaf = f"{target.rstrip('/')}/_batch_id={_folder_part(batch)}/_pipeline_run_id={_folder_part(run)}"
        store, place = fs.FileSystem.from_uri(store_uri(leaf))
        if store.get_file_info(place).type == fs.FileType.NotFound:
            return BRONZE_CLEANUP_NOOP, 0, None
        rows = 0
        for info in store.get_file_info(fs.FileSelector(place)):
            if info.type == fs.FileType.File and info.base_name.endswith(".parquet") and info.base_name[0] not in "._":
                try:
                    with store.open_input_file(info.path) as file:
                        rows += pq.ParquetFile(file).metadata.num_rows
                except ValueError:  # not a complete file: no row of it was ever readable
                    continue
        store.delete_dir(place)
        if store.get_file_info(place).type != fs.FileType.NotFound:
            return BRONZE_CLEANUP_INCOMPLETE, rows, f"rows of run {run_id} remain in {target}"
        return BRONZE_CLEANUP_DONE, rows, None
    except Exception as problem:  # told per execution; the others are still removed
        return BRONZE_CLEANUP_FAILED, None, str(problem)[:1000]


def remove_folders(folders: DataFrame) -> DataFrame:
    """Remove the folder trees in column ``path`` (qualified), each by the task that has its row."""

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for path in batch["path"]:
                store, place = fs.FileSystem.from_uri(store_uri(path))
                if store.get_file_info(place).type == fs.FileType.Directory:
                    store.delete_dir(place)
            yield batch

    width = folders.sparkSession.sparkContext.defaultParallelism
    return folders.select("path").repartition(width, "path").mapInPandas(remove, "path string")
