"""Raw landing: byte-for-byte copies below an execution-scoped folder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.errors import (
    LANDING_CLEANUP_FAILED, LANDING_CLEANUP_INCOMPLETE, LANDING_FILE_COUNT_MISMATCH, LoadError,
)
from tidegate.functions.text import is_folder_name
from tidegate.operators.bronze import checked_segment, path_exists, qualified, remove_folder
from tidegate.sources.files import FOUND, store_uri, discover, relative_to

CHUNK = 8 * 1024 * 1024
PARTIAL = ".partial"


def landing_leaf(base: str, date: str, config_id, batch_id: str, run_id: str) -> str:
    """Landing folder of one execution below the feed's base folder."""
    parts = [
        f"ingestion_date={checked_segment('ingestion_date', date)}",
        f"ingestion_config_id={checked_segment('ingestion_config_id', config_id)}",
        f"batch_id={checked_segment('batch_id', batch_id)}",
        f"pipeline_run_id={checked_segment('pipeline_run_id', run_id)}",
    ]
    return "/".join([base.rstrip("/"), *parts])


def _copy(source: str, target: str) -> tuple[int, str]:
    """Stream one file to the target (both URIs); returns its bytes and SHA-256.

    The copy is written beside the target and moved there when complete, so a
    repeated or speculative task never leaves half a file under the final name.
    """
    from pyarrow import fs

    read_from, source_path = fs.FileSystem.from_uri(source)
    write_to, target_path = fs.FileSystem.from_uri(target)
    folder, _, name = target_path.rpartition("/")
    write_to.create_dir(folder, recursive=True)
    partial = f"{folder}/.{name}.{uuid.uuid4().hex}{PARTIAL}"
    digest, size = hashlib.sha256(), 0
    with read_from.open_input_stream(source_path) as incoming:
        with write_to.open_output_stream(partial) as outgoing:
            while block := incoming.read(CHUNK):
                outgoing.write(block)
                digest.update(block)
                size += len(block)
    write_to.move(partial, target_path)
    return size, digest.hexdigest()


MANIFEST = "source_path string, relative_path string, length long, written long, sha256 string"


def land_files(spark: SparkSession, files: DataFrame, root: str, leaf: str) -> DataFrame:
    """Copy discovered files below the leaf, keeping their folders; one row each.

    Tasks receive file names only and stream the contents, so no file has to fit
    into memory.  Lazy: the copy happens when the manifest is written or counted;
    write it once and read it back.
    """
    target_root = leaf if "://" in leaf else "file:" + leaf

    def copy_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            copied = [
                _copy(store_uri(path), store_uri(f"{target_root}/{relative}"))
                for path, relative in zip(batch["source_path"], batch["relative_path"])
            ]
            yield batch.assign(
                written=[size for size, _ in copied], sha256=[digest for _, digest in copied]
            )

    listed = files.select(
        F.col("path").alias("source_path"),
        relative_to(F.col("path"), root).alias("relative_path"),
        "length",
    )
    tasks = spark.sparkContext.defaultParallelism * 4
    return listed.repartition(tasks, "relative_path").mapInPandas(copy_batch, MANIFEST)


def landed_files(spark: SparkSession, leaf: str) -> DataFrame:
    """The files below a leaf, listed anew; none where nothing was landed."""
    if path_exists(spark, leaf):
        # what a lost task left half copied is not landed
        return discover(spark, leaf, hidden=True).where(~F.endswith("path", F.lit(PARTIAL)))
    return spark.createDataFrame([], FOUND)


def landing_gate(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Compare what was found with what lies in the leaf, before the no-data test.

    ``landed`` is a listing of the leaf made after the copies, so a file lost or cut short
    after its copy was acknowledged is noticed.
    """
    found = manifest.select(F.lit(True).alias("_source"), "length")
    both = found.unionByName(landed.select(F.lit(False).alias("_source"), "length"))
    length = lambda source: F.when(F.col("_source") == source, F.col("length"))
    totals = both.agg(
        F.count(length(True)).alias("files_read"),
        F.count(length(False)).alias("files_written"),
        F.coalesce(F.sum(length(True)), F.lit(0)).alias("bytes_read"),
        F.coalesce(F.sum(length(False)), F.lit(0)).alias("bytes_written"),
    )
    return gate_outcome(totals)


def gate_outcome(totals: DataFrame) -> DataFrame:
    """Outcome per row of counts: mismatch fails, nothing found skips, else go on.

    Bytes are compared where the row has them.
    """
    same = F.col("files_read") == F.col("files_written")
    if {"bytes_read", "bytes_written"} <= set(totals.columns):
        same = same & (F.col("bytes_read") == F.col("bytes_written"))
    return totals.withColumns(
        {
            "outcome": F.when(~same, "FAILED")
            .when(F.col("files_read") == 0, "SKIPPED")
            .otherwise("PROCESS"),
            "error_code": F.when(~same, LANDING_FILE_COUNT_MISMATCH),
        }
    )


def own_leaf(path: str, config_id, batch_id: str, run_id: str) -> bool:
    """Whether the path is exactly this execution's landing folder, by building that anew."""
    base, _, below = path.rstrip("/").rpartition("/ingestion_date=")
    date = below.partition("/")[0]
    own = landing_leaf(base, date, config_id, batch_id, run_id) if base and date else None
    return own == path.rstrip("/") and not {".", ".."} & set(base.split("/"))


def is_own_leaf(path: Column, config_id: Column, batch_id: Column, run_id: Column) -> Column:
    """The same test on columns."""
    bare = F.rtrim(path, F.lit("/"))
    date = F.regexp_extract(path, ".*/ingestion_date=([^/]+)", 1)
    names = {"ingestion_date": date, "ingestion_config_id": config_id, "batch_id": batch_id, "pipeline_run_id": run_id}
    tail = F.concat(*[part for name, value in names.items() for part in (F.lit(f"/{name}="), value)])
    base = F.left(bare, F.length(bare) - F.length(tail))
    safe = F.lit(True)
    for value in names.values():
        safe = safe & is_folder_name(value)
    inside = ~F.rlike(base, F.lit(r"(^|/)\.\.?(/|$)")) & (F.length(base) > 0)
    return F.coalesce(safe & F.endswith(bare, tail) & inside, F.lit(False))


def delete_landing(spark: SparkSession, path: str, config_id, batch_id: str, run_id: str) -> None:
    """Remove one execution's landing folder, and nothing that is not exactly that."""
    if not own_leaf(path, config_id, batch_id, run_id):
        raise ValueError(f"not the landing folder of this execution: {path}")
    if not remove_folder(spark, path):
        raise LoadError(LANDING_CLEANUP_INCOMPLETE, path)


CLEARED = "pipeline_run_id string, code string, message string"


def delete_landings(spark: SparkSession, executions: DataFrame) -> DataFrame:
    """Remove many executions' landing folders (``landing_path``, ``ingestion_config_id``,
    ``batch_id``, ``pipeline_run_id``) in tasks; one row for each that could not be removed."""
    root = qualified(spark, "/").rstrip("/")

    def clear(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            failed = []
            for path, config, name, run in batch.itertuples(index=False, name=None):
                try:
                    if not own_leaf(path, config, name, run):
                        raise ValueError(f"not the landing folder of this execution: {path}")
                    full = path if ":" in path.split("/")[0] else f"{root}/{path.lstrip('/')}"
                    store, place = fs.FileSystem.from_uri(store_uri(full.rstrip("/")))
                    if store.get_file_info(place).type == fs.FileType.Directory:
                        store.delete_dir(place)
                except Exception as problem:  # told per execution; the others are still removed
                    failed.append((run, LANDING_CLEANUP_FAILED, str(problem)[:1000]))
            yield pd.DataFrame(failed, columns=["pipeline_run_id", "code", "message"])

    keys = executions.select("landing_path", "ingestion_config_id", "batch_id", "pipeline_run_id")
    width = spark.sparkContext.defaultParallelism
    return keys.where("landing_path > ''").repartition(width, "pipeline_run_id").mapInPandas(clear, CLEARED)
