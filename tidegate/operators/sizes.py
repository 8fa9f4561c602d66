"""Broadcasting behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_LIMIT = 50_000


def fetch_small(df: DataFrame, limit: int = ROW_LIMIT) -> DataFrame | None:
    """The frame ready to be broadcast, or None if it has more than ``limit`` rows.

    At most ``limit`` + 1 rows reach the driver.
    """
    rows = df.limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema=df.schema))


def small_side(df: DataFrame, limit: int = ROW_LIMIT) -> DataFrame:
    """The frame ready to be broadcast; as it is, to be shuffled, where it is larger."""
    small = fetch_small(df, limit)
    return df if small is None else small


def only_asked_for(facts: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """Facts that can match the keys asked for.

    A few keys are broadcast to the facts, so that a join which follows moves only
    the matching rows.  For many keys the facts are left to that join.
    """
    keys = fetch_small(asked.select(key).where(F.col(key).isNotNull()).distinct())
    return facts if keys is None else facts.join(keys, key, "left_semi")
