"""Lineage columns of loaded rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.sources.files import relative_to


def utc_now_text() -> str:
    """The current instant, cut to milliseconds, with the UTC mark."""
    now = datetime.now(timezone.utc)
    return f"{now:%Y-%m-%dT%H:%M:%S}.{now.microsecond // 1000:03d}Z"


def stamp_lineage(
    df: DataFrame, batch_id: str, run_id: str, instant: str, with_date: bool = False
) -> DataFrame:
    """Add the batch, the run and the one instant of this execution.

    ``with_date`` also adds the UTC date of the same instant (file loads).
    """
    moment = F.lit(instant).cast("timestamp_ntz")
    columns = {
        "_batch_id": F.lit(batch_id),
        "_pipeline_run_id": F.lit(run_id),
        "_ingestion_timestamp": moment,
    }
    if with_date:
        columns["_ingestion_date"] = moment.cast("date")
    return df.withColumns(columns)


def stamp_file_lineage(df: DataFrame, landing_root: str, source_root: str) -> DataFrame:
    """Add where each row's file came from.

    The path below the landing root is put under the source root again.  Must
    be applied to the frame a file reader returned, before any join or grouping.
    """
    prefix = source_root if source_root.endswith("/") else source_root + "/"
    uri = F.col("_metadata.file_path")
    # decoding would read a plus sign as a space; most paths need no decoding at all
    decoded = F.try_url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    landed = F.when(F.contains(uri, F.lit("%")), decoded).otherwise(uri)
    relative = relative_to(landed, landing_root)
    return df.select(
        "*",
        F.substring_index(relative, "/", -1).alias("_source_file_name"),
        F.concat(F.lit(prefix), relative).alias("_source_file_path"),
    )
