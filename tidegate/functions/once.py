"""Computing an expensive column exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps read but never repeat.

    The optimizer copies a column's expression into every filter and lambda that
    uses it.  For a parsed document that means parsing again at each use.  Behind
    a one-row ``inline`` the columns are plain attributes.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))
