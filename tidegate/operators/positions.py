"""Dense 1..N positions over a whole table, without one big sort task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in these bits
IDENTITY = ["_id1", "_id2"]


def _identified(df: DataFrame) -> DataFrame:
    """The rows with a 128-bit hash of all their columns and of where NULLs stand."""
    parts = [part for name in df.columns for part in (F.col(name), F.col(name).isNull())]
    return df.withColumns(
        {"_id1": F.xxhash64(*parts), "_id2": F.xxhash64(F.lit(1), *reversed(parts))}
    )


def rank_directory(df: DataFrame, keys: list[str]) -> DataFrame:
    """For each row hash (``_id1``, ``_id2``) the first position its rows take (``_first``).

    Only the keys and the hash are sorted and stored: rows are split by key range and sorted
    inside each split; a split's rows start after the rows of all earlier splits, and only
    the number of rows per split goes through a window.  The sorted splits are
    checkpointed, so that lost executors cannot change which row is where between the two
    uses.  The hash breaks ties, which also spreads a frequent key value.
    """
    order = [F.col(key) for key in keys] + [F.col(name) for name in IDENTITY]
    narrow = _identified(df).select(*dict.fromkeys(keys), *IDENTITY)
    sorted_keys = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = sorted_keys.select(*IDENTITY, F.monotonically_increasing_id().alias("_tag")).checkpoint()
    split = F.shiftright("_tag", ROW_BITS)
    sizes = placed.groupBy(split.alias("_split")).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per split: bounded by the number of partitions, not by the data
    earlier = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_split", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    row_in_split = F.col("_tag").bitwiseAND((1 << ROW_BITS) - 1)
    numbered = placed.withColumn("_split", split).join(F.broadcast(starts), "_split").select(
        *IDENTITY, (F.col("_before") + row_in_split + 1).alias("_position")
    )
    return numbered.groupBy(*IDENTITY).agg(F.min("_position").alias("_first"))


def dense_positions(df: DataFrame, keys: list[str], name: str = "position") -> DataFrame:
    """Add each row's place in the order of the keys, counted from 1.

    The rows meet a directory of ranks over their keys by their own hash, in one shuffle of
    the rows; they are neither sorted as a whole nor stored.  Equal rows share the places
    from their first one on.
    """
    found = _identified(df).join(rank_directory(df, keys), IDENTITY)
    copy = F.row_number().over(Window.partitionBy(*IDENTITY).orderBy("_first"))
    return found.select(*df.columns, (F.col("_first") + copy - 1).alias(name))


def positional_join(
    children: DataFrame, child_keys: list[str], parents: DataFrame, parent_keys: list[str],
    take: list[str],
) -> DataFrame:
    """Give every child the parent at its own position, wrapping round the parents."""
    placed_parents = dense_positions(parents.select(*parent_keys, *take), parent_keys, "_parent")
    total = placed_parents.count()
    if total == 0:
        return children.limit(0).select("*", *[F.lit(None).alias(name) for name in take])
    placed = dense_positions(children, child_keys, "child_position")
    slot = F.pmod(F.col("child_position") - 1, F.lit(total)) + 1
    return placed.join(
        placed_parents.select("_parent", *take), slot == F.col("_parent")
    ).drop("_parent")
