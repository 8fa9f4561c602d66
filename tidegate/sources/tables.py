"""Table reads: everything, a bounded window, the current upper bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.temporal import bound_instant, sortable_bound


def read_table(spark: SparkSession, location: str) -> DataFrame:
    """A catalog table by name, or Parquet files where a path is given."""
    if "/" in location:
        return spark.read.parquet(location)
    return spark.table(location)


def window_rows(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """Rows with LOW < column <= HIGH.

    Both bounds are literals of the column's own kind, so the comparison reaches
    the Parquet or JDBC scan without a cast on the column.  A text column holds
    instants with up to seven fraction digits and is compared in their sortable form.
    """
    kind = df.schema[column].dataType
    if kind.typeName() == "string":
        place, lower, upper = (sortable_bound(c) for c in (F.col(column), F.lit(low), F.lit(high)))
        return df.where((place > lower) & (place <= upper))
    if kind.typeName() in ("timestamp_ntz", "timestamp"):
        lower, upper = (bound_instant(text).cast(kind) for text in (low, high))
    else:
        lower, upper = (F.lit(text).cast(kind) for text in (low, high))
    return df.where((F.col(column) > lower) & (F.col(column) <= upper))


def upper_bound(df: DataFrame, column: str) -> DataFrame:
    """One row with the highest value of the watermark column, a text as it stands."""
    if df.schema[column].dataType.typeName() == "string":
        return df.agg(F.max_by(column, sortable_bound(F.col(column))).alias("upper_bound"))
    return df.agg(F.max(column).alias("upper_bound"))
