"""A file feed read as a stream: each file is taken once, then the query ends."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidegate.operators.bronze import append_execution, delete_execution
from tidegate.operators.lineage import stamp_file_lineage, stamp_lineage, utc_now_text
from tidegate.sources.readers import delimited_settings


def load_available_files(
    spark: SparkSession,
    root: str,
    schema: StructType,
    options: dict[str, Any],
    source_root: str,
    table: str,
    checkpoint: str,
    feed: str,
) -> None:
    """Append all files not yet taken, with the lineage of a batch load.

    Batch and run id follow from the feed and the micro-batch number.  A
    micro-batch repeated after a failure first removes what its earlier attempt
    left, so its rows are stored once.
    """
    incoming = (
        spark.readStream.schema(schema)
        .options(**delimited_settings(options))
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", options.get("file_name_pattern") or "*")
        .csv(root)
    )

    def append(rows: DataFrame, epoch: int) -> None:
        batch, run = f"{feed}-{epoch}", f"{feed}-{epoch}"
        delete_execution(rows.sparkSession, table, batch, run)
        append_execution(stamp_lineage(rows, batch, run, utc_now_text(), with_date=True), table)

    query = (
        stamp_file_lineage(incoming, root, source_root)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
