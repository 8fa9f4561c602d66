"""Control tables as versioned Parquet folders: audit rows and checkpoints.

A version is first claimed by creating a marker file, which only one writer can
do; then its audit rows are written, and last its state.  Readers see a version
once its state is complete, so both become visible together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidegate.errors import WATERMARK_CONFLICT, VersionTaken
from tidegate.operators.positions import dense_positions
from tidegate.schemas import AUDIT, AUDIT_LOG, STATE
from tidegate.session import local_frame


@dataclass
class ControlStore:
    spark: SparkSession
    root: str

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def version(self) -> int:
        """The highest version whose state is complete; 0 before the first."""
        files, pattern = self._path("state/version=*/_SUCCESS")
        done = files.globStatus(pattern) or []
        return max((int(d.getPath().getParent().getName().split("=")[1]) for d in done), default=0)

    def state(self, version: int | None = None) -> DataFrame:
        number = self.version() if version is None else version
        if number == 0:
            return local_frame(self.spark, [], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.root}/state/version={number}")

    def audit(self, version: int | None = None) -> DataFrame:
        """All audit rows up to a version, with their ids and the time they were published."""
        number = self.version() if version is None else version
        return self._versions(number).where(F.col("version") <= number).drop("version")

    def _versions(self, number: int) -> DataFrame:
        stored = StructType([*AUDIT_LOG.fields, StructField("version", IntegerType())])
        files, folder = self._path("audit")
        if number == 0 or not files.exists(folder):
            return local_frame(self.spark, [], stored)
        return self.spark.read.schema(stored).parquet(f"{self.root}/audit")

    def _last_id(self, base: int) -> int:
        """The highest row id so far: that of the base version, or of earlier ones if it has no rows."""
        rows = self._versions(base)
        for part in (F.col("version") == base, F.col("version") < base):
            found = rows.where(part).agg(F.max("ingestion_log_id")).first()[0]
            if found is not None:
                return found
        return 0

    def _logged(self, audit_rows: DataFrame, base: int) -> DataFrame:
        """The rows with the ids that follow the base version's, in the order the runs ended."""
        rows = audit_rows.select(*AUDIT.fieldNames())
        placed = dense_positions(rows, ["end_time", "pipeline_run_id"], "_place")
        return placed.select(
            (F.col("_place") + self._last_id(base)).alias("ingestion_log_id"), *rows.columns,
            F.localtimestamp().alias("log_timestamp"),
        )

    def commit(self, base: int, audit_rows: DataFrame, state: DataFrame) -> int:
        """Publish the next version; fails when another writer took it first."""
        number = base + 1
        files, marker = self._path(f"claims/version={number}")
        try:
            files.create(marker, False).close()
        except Exception as problem:
            if not files.exists(marker):
                raise
            raise VersionTaken(
                WATERMARK_CONFLICT, f"version {number} was taken by another writer"
            ) from problem
        self._logged(audit_rows, base).write.mode("overwrite").parquet(f"{self.root}/audit/version={number}")
        state.write.mode("overwrite").parquet(f"{self.root}/state/version={number}")
        return number

    def release(self, number: int) -> None:
        """Give up a claimed version whose writer died before completing it."""
        if number <= self.version():
            raise ValueError(f"version {number} is complete")
        for name in (f"audit/version={number}", f"state/version={number}",
                     f"claims/version={number}"):
            files, path = self._path(name)
            files.delete(path, True)
